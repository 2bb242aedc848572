"""Event sink: fixed schema, REQUIRED columns enforced, day partitions.

Sink columns (fixed): ``event_id STRING NOT NULL, user_id STRING NOT NULL,
timestamp TIMESTAMP NOT NULL, payload JSON text, user_name STRING,
user_location STRING``, plus the partition column ``event_date``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidewater.functions.coerce import try_timestamp
from tidewater.functions.size import observed
from tidewater.operators.validate import BAD_TIMESTAMP

SINK_COLUMNS = ("event_id", "user_id", "timestamp", "payload", "user_name", "user_location")
REQUIRED = ("event_id", "user_id", "timestamp")


def utc_date(ts: Column) -> Column:
    """The UTC calendar day of an instant, whatever the session time zone."""
    return F.to_date(F.to_utc_timestamp(ts, F.current_timezone()))


def to_sink_rows(enriched: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)``: sink-shaped rows and messages whose timestamp
    text is not a date-time (reason ``bad_timestamp``).

    With ``strict`` an unparsable timestamp fails the load instead.
    """
    ts = try_timestamp("ts_text")
    if strict:
        ts = F.coalesce(ts, F.raise_error(F.lit("unparsable event timestamp")).cast("timestamp"))
    parsed = enriched.withColumn("timestamp", ts)
    extras = [c for c in enriched.columns if c not in SINK_COLUMNS and c != "ts_text"]
    rows = parsed.where(F.col("timestamp").isNotNull()).select(
        *SINK_COLUMNS, utc_date(F.col("timestamp")).alias("event_date"), *extras)
    bad = parsed.where(F.col("timestamp").isNull()).select(
        *[c for c in enriched.columns], F.lit(BAD_TIMESTAMP).alias("reason_load"))
    return rows, bad


def enforce_required(rows: DataFrame) -> DataFrame:
    """Fail the write when a REQUIRED column is NULL (checked inside the tasks).

    The check is part of the written projection, so it runs only on rows
    that reach the sink and cannot be pruned or reordered before filters.
    """
    types = dict(rows.dtypes)
    return rows.select(*[
        F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} is required")).cast(types[c])).alias(c)
        if c in REQUIRED else F.col(c) for c in rows.columns])


def append_daily(rows: DataFrame, path: str, batch_id: str | int | None = None,
                 cluster_by: tuple[str, ...] = ()) -> int:
    """Append sink rows partitioned by ``event_date``.

    With ``batch_id`` the write is idempotent: rows go to
    ``event_date=<d>/ingest_batch=<id>`` under dynamic partition overwrite,
    so replaying a batch replaces exactly its own partitions.
    ``cluster_by`` (e.g. ``("user_id",)``) range-partitions and sorts rows on
    (event_date, cluster columns) so files carry tight min/max statistics; a
    busy day is split over several tasks rather than written by one. Without it rows are
    only rebalanced on the day.
    Returns the number of rows loaded, observed during the write itself.
    """
    out = enforce_required(rows.select(*SINK_COLUMNS, "event_date"))
    if cluster_by:
        out = out.repartitionByRange("event_date", *cluster_by) \
            .sortWithinPartitions("event_date", *cluster_by)
    else:
        # rows of a day meet in few tasks, so files do not multiply by tasks x days;
        # adaptive execution splits a busy day and joins small ones
        out = out.hint("rebalance", F.col("event_date"))
    # counted above the exchange: adaptive execution drops what lies below an empty one
    obs = Observation(f"loaded_{uuid.uuid4().hex[:8]}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if batch_id is None:
        out.write.mode("append").partitionBy("event_date").parquet(path)
    else:
        (out.withColumn("ingest_batch", F.lit(str(batch_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "ingest_batch").parquet(path))
    return observed(obs, "rows")["rows"]
