"""Left lookup enrichment with at most one match per message.

A message whose key is found gets the lookup's columns (a NULL in the
lookup overwrites); a message not found, or with an empty / absent key,
is kept unchanged. The lookup is de-duplicated on its key first so the
join never multiplies rows. It is broadcast only after its row count and
byte size are measured and found under their limits; above them the join
is a shuffle join (AQE still splits skewed message keys).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions.size import fits_broadcast

DEFAULT_MAX_BROADCAST_ROWS = 5_000_000


PREPARED_KEY = "_lk"


def prepare_lookup(dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key (deterministic: the smallest column tuple), plus a match flag.

    Already prepared lookups are returned unchanged.
    """
    if PREPARED_KEY in dim.columns:
        return dim
    one = dim.groupBy(key).agg(F.min(F.struct(*columns)).alias("_r"))
    return one.select(F.col(key).alias("_lk"), *[F.col(f"_r.{c}").alias(f"_l_{c}") for c in columns],
                      F.lit(True).alias("_matched"))


def load_lookup(spark: SparkSession, loader: Callable[[], DataFrame], key: str,
                columns: Sequence[str]) -> tuple[DataFrame, bool]:
    """``(lookup, available)``: an empty lookup of the same shape when loading fails.

    Messages then pass through unenriched and are all counted as misses.
    """
    try:
        dim = loader()
        dim = dim.select(key, *columns)
        dim.schema  # resolve now, so a missing table or column fails here
        return dim, True
    except Exception:  # noqa: BLE001 - any failure of the lookup source degrades the same way
        return empty_lookup(spark, key, columns), False


def empty_lookup(spark: SparkSession, key: str, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in (key, *columns)]))


def lookup_fits_broadcast(dim: DataFrame, key: str, columns: Sequence[str],
                          max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    """Whether the de-duplicated lookup is small enough to broadcast (rows and bytes)."""
    return fits_broadcast(prepare_lookup(dim, key, columns), max_broadcast_rows)


def enrich_left(messages: DataFrame, dim: DataFrame, key: str = "user_id",
                columns: Sequence[str] = ("user_name", "user_location"), *,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                broadcast: bool | None = None) -> DataFrame:
    """Messages with lookup columns filled in, plus boolean ``matched``.

    ``broadcast`` is the outcome of ``lookup_fits_broadcast`` when already
    known (a stream decides once, not per micro-batch); None counts now.
    """
    lk = prepare_lookup(dim, key, columns)
    if broadcast is None:
        broadcast = fits_broadcast(lk, max_broadcast_rows)
    if broadcast:
        lk = F.broadcast(lk)
    k = F.col(key)
    probe = messages.withColumn("_pk", F.when(k.isNotNull() & (k != ""), k))
    j = probe.join(lk, F.col("_pk") == F.col("_lk"), "left")
    m = F.coalesce(F.col("_matched"), F.lit(False))
    out = []
    for c in messages.columns:
        if c in columns:
            out.append(F.when(m, F.col(f"_l_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    for c in columns:
        if c not in messages.columns:
            out.append(F.when(m, F.col(f"_l_{c}")).alias(c))
    return j.select(*out, m.alias("matched"))


def enrich_stats(enriched: DataFrame) -> DataFrame:
    """Processed, enriched and missed (not found, no key or lookup down) counts."""
    return enriched.agg(F.count(F.lit(1)).alias("processed"),
                        F.count_if("matched").alias("enriched"),
                        F.count_if(~F.col("matched")).alias("missed"))
