"""Exact dedup by SHA-256 groups after a content sort, in DataFrame operations only.

Texts are normalised (each run of ASCII white space becomes one space).
Sampled splitters range-partition the rows by their normalised bytes: the leading
bytes, then a hash and a salt of the identifier, so that the splitters stay small,
rows that share a long beginning still divide, and a text that a third of
all rows repeat spreads over many partitions. An external sort inside each
partition places equal texts next to each other and numbers the rows of a run; that
number only breaks ties between rows of the same identifier and text. Which texts are
copies, the smallest identifier and the size of a group come from grouping all
rows' SHA-256 digests, aggregated before they are shuffled.

Defined results: a null text counts as empty, and empty texts are copies of
each other. Null identifiers come last: such a row stays only if no equal text has an
identifier. Of repeated rows (same identifier, same text) one stays. Extra
columns do not matter; an empty table gives an empty one. Texts are digested
whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions
from .graph import stored

BLANKS = r"[\x20\x09-\x0D]+"
SPLITTER_CHARS = 16  # leading characters that the splitters compare; the rest of the order is by hash
SALTS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def _runs(rows: DataFrame) -> DataFrame:
    """``rows`` (with _id, _norm) sorted by content; adds _sha, _place (in its run, from 1)."""
    keyed = rows.select(
        "*", F.substring("_norm", 1, SPLITTER_CHARS).alias("_lead"), F.xxhash64("_norm").alias("_hash"),
        F.pmod(F.xxhash64("_id"), F.lit(SALTS)).alias("_salt"))
    parts = shuffle_partitions(rows.sparkSession)
    dealt = keyed.repartitionByRange(parts, "_lead", "_hash", "_salt")
    # Range partitions keep (_lead, _hash, _salt) together, so the window needs no
    # further shuffle; a run ends where the whole neighbouring texts differ.
    run = Window.partitionBy("_lead", "_hash", "_salt", "_norm").orderBy(F.col("_id").asc_nulls_last())
    return (dealt.withColumn("_place", F.row_number().over(run))
            .withColumn("_sha", F.sha2(F.encode("_norm", "UTF-8"), 256)))


def _groups(runs: DataFrame) -> DataFrame:
    """Smallest identifier and size of each group of equal texts."""
    return runs.groupBy("_sha").agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the identifier, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm"))
    # the texts are sorted once; what follows works on the digests
    runs = stored(_runs(rows).select("_id", "_sha", "_place"), "exact-runs")
    # the key is recomputed so that the join deals both sides anew: adaptive execution can split a
    # hot text then, which it cannot where the aggregate's own partitions are used
    groups = _groups(runs).withColumn("_sha", F.lower("_sha"))
    return (runs.join(groups, "_sha")
            .select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
                    (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_place") == 1)).alias("kept"),
                    F.col("_sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns unchanged."""
    kept = exact_dedup(docs.select(id_col, text_col), id_col, text_col).filter("kept").select(
        F.col(id_col).alias("_keep"), F.xxhash64(id_col).alias("_key"), F.col("text_sha256").alias("_own"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.xxhash64(id_col).alias("_key"),
                       F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256).alias("_own"))
    same = ((rows["_key"] == kept["_key"]) & (rows["_own"] == kept["_own"]) & rows["_id"].eqNullSafe(kept["_keep"]))
    stays = rows.join(kept, same, "left_semi")
    # repeated rows meet in the partitions that the join has made
    repeat = Window.partitionBy("_key", "_own", "_id").orderBy(F.lit(0))
    return stays.withColumn("_place", F.row_number().over(repeat)).filter("_place = 1").select("_row.*")
