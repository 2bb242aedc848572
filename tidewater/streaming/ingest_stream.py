"""Event ingest with Structured Streaming.

The stream source (Kafka, or a folder of message files) is drained with
``trigger(availableNow=True)``; each micro-batch runs the batch job in
``foreachBatch`` and appends to the day-partitioned sink keyed by the
stream's identity and the batch id, so a replayed batch overwrites its own
partitions instead of duplicating rows. Source positions live in the checkpoint and advance
only after the sink write commits. Keep-first dedup is per micro-batch,
as in the batch job; ``cross_batch_delay`` also takes out valid messages whose
key an earlier micro-batch has loaded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

from tidewater import paths
from tidewater.plans.ingest import SUMMARY, load_batch, prepare_for_run
from tidewater.spec import IngestSpec

MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType()), StructField("value", BinaryType()),
    StructField("topic", StringType()), StructField("partition", IntegerType()),
    StructField("offset", LongType()), StructField("timestamp", TimestampType()),
])


def read_message_stream(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                        options: dict[str, str] | None = None) -> DataFrame:
    """A streaming DataFrame with the Kafka source's columns."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        r = r.schema(MESSAGE_SCHEMA)
    return r.load(path) if path else r.load()


def cross_batch_dedup(messages: DataFrame, key_expr, delay: str = "1 hour") -> DataFrame:
    """A stream without the repeats of a key within the watermark delay, by Structured Streaming's state.

    Which copy of a micro-batch stays is open, messages without a key count as copies of
    each other, and messages older than the watermark are dropped; ``ingest_stream`` uses
    ``SeenKeys`` instead, after validation.
    """
    return (messages.withColumn("_k", key_expr).withWatermark("timestamp", delay)
            .dropDuplicatesWithinWatermark(["_k"]).drop("_k"))


class SeenKeys:
    """Keys loaded by earlier micro-batches, kept for ``delay`` of message time.

    One folder per micro-batch under ``path`` (written before the batch's rows, so a
    replay finds and replaces its own). A batch's rows whose key an earlier batch has are taken
    out; nothing is ever dropped for being late. Folders whose newest message is older than the
    newest of all by more than ``delay`` are removed.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, delay: str):
        self.spark, self.path, self.key, self.delay = spark, path.rstrip("/"), key, delay

    def _folders(self, before: str) -> list[str]:
        return [full for name, full, is_dir in paths.list_dir(self.spark, self.path)
                if is_dir and name.startswith("batch=") and name < f"batch={before}"]

    def fresh(self, batch_id: str):
        def keep(rows: DataFrame) -> DataFrame:
            folders = self._folders(batch_id)
            if not folders:
                return rows
            seen = self.spark.read.parquet(*folders).select("key")
            return rows.join(seen, rows[self.key] == seen["key"], "left_anti")
        return keep

    def add(self, batch_id: str, newest, rows: DataFrame) -> None:
        out = f"{self.path}/batch={batch_id}"
        (rows.select(F.col(self.key).alias("key")).withColumn("newest", F.lit(newest).cast("timestamp"))
         .write.mode("overwrite").parquet(out))

    def expire(self, batch_id: str) -> None:
        folders = self._folders(f"{batch_id}~")
        if not folders:
            return
        ages = (self.spark.read.parquet(*folders).groupBy(F.col("_metadata.file_path").alias("file"))
                .agg(F.max("newest").alias("newest")))
        last = F.max("newest").over(Window.partitionBy())
        old = ages.withColumn("gone", F.col("newest") < last - F.expr(f"INTERVAL {self.delay}"))
        per = {}
        for r in old.collect():  # one row per file of small key tables
            folder = r["file"].rsplit("/", 1)[0]
            per[folder] = per.get(folder, True) and bool(r["gone"])
        for folder, gone in per.items():
            if gone:
                paths.remove(self.spark, folder)


def ingest_stream(stream: DataFrame, lookup: DataFrame | Callable[[], DataFrame], sink_path: str, checkpoint: str,
                  spec: IngestSpec = IngestSpec(), rejects_path: str | None = None,
                  summary_path: str | None = None) -> StreamingQuery:
    """Drain the stream once (``availableNow``) and return the finished query.

    The lookup is read, de-duplicated and frozen once per run (checkpointed into
    the shared folder), so micro-batches neither re-aggregate it nor see it
    change mid-run; whether it is broadcast is decided once from its size.
    Messages turned away go to ``rejects_path`` and each micro-batch's counts to ``summary_path``.
    How much a micro-batch takes is the source's option (``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``): cutting a batch short here would lose what it leaves.
    """
    if spec.max_messages:
        raise ValueError("a stream is bounded at its source: maxOffsetsPerTrigger or maxFilesPerTrigger")
    spark = stream.sparkSession
    prepared = prepare_for_run(spark, lookup, spec)
    keys = SeenKeys(spark, f"{checkpoint.rstrip('/')}-keys", spec.dedup_key, spec.cross_batch_delay) \
        if spec.cross_batch_delay else None

    # Replays of a micro-batch (same checkpoint) overwrite their own
    # partitions; another checkpoint is another stream and never collides.
    stream_id = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def each(batch: DataFrame, number: int) -> None:
        batch_id = f"{stream_id}-{number:012d}"
        fresh = add = None
        if keys:
            newest = batch.agg(F.max("timestamp")).first()[0]
            fresh, add = keys.fresh(batch_id), lambda rows: keys.add(batch_id, newest, rows)
        counts = load_batch(batch, prepared, sink_path, spec, rejects_path=rejects_path, batch_id=batch_id,
                            fresh=fresh, loaded_keys=add)
        if summary_path:
            (spark.createDataFrame([tuple(counts.values())], SUMMARY).coalesce(1).write.mode("overwrite")
             .parquet(f"{summary_path.rstrip('/')}/ingest_batch={batch_id}"))
        if keys:
            keys.expire(batch_id)

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
