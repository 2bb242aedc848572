"""Event ingest as one Spark plan, and as a job that loads it.

decode -> validate -> keep-first dedup -> left lookup -> sink rows.
The only shuffle is the dedup on ``event_id`` (with a partial aggregate
before it); the lookup is a broadcast join when its checked size allows.
``load_batch`` writes the rows, writes the messages that were turned away
with their reasons, and counts every step on the pass that loads.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidewater.functions.json import decode_json, evaluate_once, message_text, text_kind
from tidewater.operators.dedup import keep_first
from tidewater.functions.size import fits_broadcast, observed
from tidewater.operators.enrich import empty_lookup, enrich_left, load_lookup, prepare_lookup
from tidewater.operators.validate import validate_messages
from tidewater.session import checkpoint_root
from tidewater.sinks.events import append_daily, to_sink_rows
from tidewater.sources.messages import bounded_messages
from tidewater.spec import IngestSpec

log = logging.getLogger(__name__)

ORDER = ("partition", "offset")
SPREAD_FACTOR = 8


@dataclass(frozen=True)
class IngestResult:
    decoded: DataFrame        # partition, offset, v (VARIANT; NULL = undecodable)
    validated: DataFrame      # decoded messages with reason + fields
    rejected: DataFrame       # decoded messages that break the contract (reason set)
    unique: DataFrame         # valid, keep-first per event_id
    enriched: DataFrame       # unique + lookup columns + matched
    rows: DataFrame           # sink rows (with event_date)
    quarantine: DataFrame     # rejected at load: bad_timestamp


def scan_partitions(df: DataFrame) -> int | None:
    """Upper estimate of the tasks that read ``df``'s files; None if it reads no files.

    From the file sizes that the optimiser has listed already: nothing is run for it.
    """
    files = len(df.inputFiles())
    if not files:
        return None
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cut = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return files + size // max(1, cut)


def spread(messages: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Rebalance a batch read as fewer partitions than the cluster has cores.

    Parsing is the CPU-heavy step; a source with few splits (one large
    file, a topic with few partitions) would parse in a handful of tasks.
    Inputs that already have enough partitions are left alone, so large
    batches never pay the extra exchange.
    """
    have = scan_partitions(messages)
    if have is None:
        return messages
    # each input partition is spread over at most this many tasks, so a tiny
    # batch on a large cluster does not fan out to every core
    want = min(min_partitions or messages.sparkSession.sparkContext.defaultParallelism,
               have * SPREAD_FACTOR)
    if have < want:
        return messages.repartition(want, *ORDER)
    return messages


def decode_messages(messages: DataFrame, rebalance: bool = True) -> DataFrame:
    """``partition, offset, v, kind`` for every message; ``v`` NULL when undecodable.

    The JSON text is parsed once per message (see ``evaluate_once``); a
    batch read as too few partitions is first spread over the cluster.
    """
    if rebalance:
        messages = spread(messages)
    dtype = messages.schema["value"].dataType
    v = decode_json(F.col("value"), dtype)
    kind = text_kind(message_text(F.col("value"), dtype))
    once = evaluate_once(messages, list(ORDER), [v.alias("v"), kind.alias("_kind")])
    return once.select(*ORDER, "v", F.when(F.col("v").isNotNull(), F.col("_kind")).alias("kind"))


def decode_stats(decoded: DataFrame) -> DataFrame:
    return decoded.agg(F.count(F.lit(1)).alias("messages"),
                       F.count_if(F.col("v").isNotNull()).alias("decoded"),
                       F.count_if(F.col("v").isNull()).alias("skipped"))


def dedup_valid(validated: DataFrame, key: str = "event_id") -> DataFrame:
    """Keep-first per key among valid messages; rows without the key are dropped."""
    valid = validated.where(F.col("reason").isNull() & F.col(key).isNotNull()).drop("reason")
    return keep_first(valid, [key], list(ORDER))


def dedup_stats(validated: DataFrame, key: str = "event_id") -> DataFrame:
    """Input, unique and duplicate counts (a missing key counts as a duplicate)."""
    valid = validated.where(F.col("reason").isNull())
    return valid.agg(F.count(F.lit(1)).alias("input_rows"),
                     F.count_distinct(F.col(key)).alias("unique_rows")).select(
        "input_rows", "unique_rows", (F.col("input_rows") - F.col("unique_rows")).alias("duplicates"))


def ingest_batch(messages: DataFrame, lookup: DataFrame, spec: IngestSpec = IngestSpec(),
                 lookup_broadcast: bool | None = None, fresh=None, observe: dict | None = None) -> IngestResult:
    """The batch chain. ``fresh`` (rows -> rows) takes out keys that earlier batches loaded; ``observe`` maps
    the steps decoded, validated and enriched to Observations that count on the pass that runs them."""
    seen = observe or {}
    if spec.max_messages:
        messages = bounded_messages(messages, spec.max_messages)
    decoded = decode_messages(messages)
    if "decoded" in seen:
        decoded = decoded.observe(seen["decoded"], F.count(F.lit(1)).alias("messages"),
                                  F.count_if(F.col("v").isNull()).alias("skipped"))
    validated = validate_messages(decoded)
    if "validated" in seen:
        validated = validated.observe(seen["validated"], F.count_if(F.col("reason").isNotNull()).alias("invalid"),
                                      F.count_if(F.col("reason").isNull()).alias("valid"))
    unique = dedup_valid(validated, spec.dedup_key)
    if fresh is not None:
        unique = fresh(unique)
    enriched = enrich_left(unique, lookup, spec.lookup_key, spec.lookup_columns,
                           max_broadcast_rows=spec.max_broadcast_rows, broadcast=lookup_broadcast)
    if "enriched" in seen:
        enriched = enriched.observe(seen["enriched"], F.count_if("matched").alias("enriched"),
                                    F.count_if(~F.col("matched")).alias("missed"))
    rows, quarantine = to_sink_rows(enriched, strict=spec.strict_load)
    rejected = validated.where(F.col("reason").isNotNull())
    return IngestResult(decoded, validated, rejected, unique, enriched, rows, quarantine)


REJECT_COLUMNS = ("partition", "offset", "reason", "event_id", "user_id", "ts_text", "payload")
SUMMARY = ("messages long, skipped long, invalid long, duplicates long, enriched long, missed long, "
           "quarantined long, loaded long, lookup_available boolean")


@dataclass(frozen=True)
class PreparedLookup:
    frame: DataFrame
    available: bool
    fits: bool


def prepare_for_run(spark: SparkSession, lookup: DataFrame | Callable[[], DataFrame], spec: IngestSpec) -> PreparedLookup:
    """The lookup read, de-duplicated and frozen once for a run.

    A lookup that cannot be found or fails while it is read is replaced by an empty
    one: messages then pass through unenriched and count as misses.
    """
    loader = lookup if callable(lookup) else lambda: lookup
    checkpoint_root(spark)
    dim, available = load_lookup(spark, loader, spec.lookup_key, spec.lookup_columns)
    try:
        frozen = prepare_lookup(dim, spec.lookup_key, spec.lookup_columns).checkpoint(eager=True)
    except Exception as e:  # noqa: BLE001 - any failure of the lookup source degrades the same way
        log.warning("lookup failed, going on without it: %s", type(e).__name__)
        dim, available = empty_lookup(spark, spec.lookup_key, spec.lookup_columns), False
        frozen = prepare_lookup(dim, spec.lookup_key, spec.lookup_columns).checkpoint(eager=True)
    return PreparedLookup(frozen, available, fits_broadcast(frozen, spec.max_broadcast_rows))


def reject_rows(result: IngestResult) -> DataFrame:
    """Messages that break the contract, and those whose timestamp is no date-time, with their reasons."""
    bad = result.quarantine.withColumn("reason", F.col("reason_load"))
    return result.rejected.select(*REJECT_COLUMNS).unionByName(bad.select(*REJECT_COLUMNS))


def load_batch(messages: DataFrame, lookup: PreparedLookup, sink_path: str, spec: IngestSpec = IngestSpec(), *,
               rejects_path: str | None = None, batch_id: str | None = None, fresh=None, loaded_keys=None) -> dict:
    """Run the chain once into the sink; returns the counts of ``SUMMARY``.

    ``duplicates`` counts valid messages that are not loaded for their key: repeats, and messages without
    one. ``loaded_keys`` is called with the unique rows before they are written.
    """
    seen = {k: Observation(f"{k}_{uuid.uuid4().hex[:8]}") for k in ("decoded", "validated", "enriched")}
    result = ingest_batch(messages, lookup.frame, spec, lookup.fits, fresh, seen)
    if loaded_keys is not None:
        loaded_keys(result.unique)
    loaded = append_daily(result.rows, sink_path, batch_id=batch_id)
    counts = {**observed(seen["decoded"], "messages", "skipped"), **observed(seen["validated"], "invalid", "valid"),
              **observed(seen["enriched"], "enriched", "missed")}
    unique = counts["enriched"] + counts["missed"]
    if rejects_path:
        plain = ingest_batch(messages, lookup.frame, spec, lookup.fits, fresh)
        rejects = reject_rows(plain)
        if batch_id is None:
            rejects.write.mode("append").parquet(rejects_path)
        else:
            (rejects.withColumn("ingest_batch", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_batch").parquet(rejects_path))
    return {"messages": counts["messages"], "skipped": counts["skipped"], "invalid": counts["invalid"],
            "duplicates": counts["valid"] - unique, "enriched": counts["enriched"], "missed": counts["missed"],
            "quarantined": unique - loaded, "loaded": loaded, "lookup_available": lookup.available}
