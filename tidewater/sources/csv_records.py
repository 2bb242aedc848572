"""CSV records cut from lines that many tasks read, with standard quoting.

A quoted field may hold line ends, so where a record starts depends on all text before it. A line maps the
state it starts in (outside or inside a quoted field) to the state it ends in, and these maps can be put together in any
grouping:

1. Files are read as lines in splits. A line's map comes from two patterns (``ends_inside``).
2. Where no line that starts outside ends inside, every line is a record; that takes one look at the lines.
3. Otherwise, for the files in which there is one: the state at each line as a function of the state at its split's start
   (a running count of the lines that swap states, from the last line that sets one), one map per split, a running
   composition over the splits of a file, and with it every line's own state.
4. Lines that start inside belong to the record of the last line that started outside, in this split or an earlier
   one. Only records of several lines are brought together by a shuffle.

Line ends inside a field come out as ``\\n``. A field's quotes count where the field starts with one; a quote further in is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewater import paths
from tidewater.session import checkpoint_root, scratch_path

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_REST = rf'[^,]*+(?:,(?:{_QUOTED}[^,]*+|(?!")[^,]*+))*+\z'
# A line that ends outside a quoted field: started outside, and started inside.
_CLOSED = rf'^(?:{_QUOTED}|(?!")){_REST}'
_CLOSING = rf'^[^"]*+(?:""[^"]*+)*+"{_REST}'
# One field with the comma before it: quoted (possibly with doubled quotes), or anything up to the next comma.
_FIELD = rf',({_QUOTED}[^,]*+|[^,]*+)'


def csv_fields(record: Column, empty: Column | None = None) -> Column:
    """The fields of one CSV record as an array of strings; a field without any character is ``empty`` (the empty string)."""
    # a comma before the first field, too: no match is empty, so none is skipped
    fields = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD), F.lit(1))
    unquoted = lambda x: F.regexp_replace(F.regexp_replace(x, r'(?s)^"(.*)"$', "$1"), '""', '"')
    plain = lambda x: F.when(x.startswith('"') & (F.length(x) > 1), unquoted(x)).otherwise(x)
    if empty is None:
        return F.transform(fields, plain)
    return F.transform(fields, lambda x: F.when(x == "", empty).otherwise(plain(x)))


def ends_inside(line: Column) -> tuple[Column, Column]:
    """0 / 1: whether a line that starts outside, and one that starts inside, ends inside a quoted field."""
    plain = F.instr(line, '"') == 0
    return (F.when(plain | line.rlike(_CLOSED), 0).otherwise(1), F.when(plain | ~line.rlike(_CLOSING), 1).otherwise(0))


def _before(df: DataFrame, parts: Sequence[str], order: str) -> DataFrame:
    """Adds ``_set`` and ``_odd``: the state before each row is ``_set``, or where that is null the starting state
    swapped ``_odd`` times. Rows map states by ``_a`` (from 0) and ``_b`` (from 1)."""
    upto = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.when((F.col("_a") == 1) & (F.col("_b") == 0), 1).otherwise(0)
    counted = df.withColumn("_swap", swaps).withColumn("_swaps", F.sum("_swap").over(upto))
    setter = F.when(F.col("_a") == F.col("_b"), F.struct(F.col("_a").alias("v"), F.col("_swaps").alias("n")))
    done = counted.withColumn("_last", F.last(setter, ignorenulls=True).over(earlier))
    since = F.col("_swaps") - F.col("_swap")
    return (done.withColumn("_set", F.when(F.col("_last").isNotNull(), F.pmod(F.col("_last.v") + since - F.col("_last.n"), F.lit(2))))
            .withColumn("_odd", F.pmod(since, F.lit(2))).drop("_swap", "_swaps", "_last"))


def _lines(spark: SparkSession, folder: str, glob: str, file_name: Column) -> DataFrame:
    return (spark.read.option("pathGlobFilter", glob).text(folder)
            .select(F.col("_metadata.file_path").alias("_path"), file_name.alias("file_name"),
                    F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"),
                    F.col("value").alias("_line")))


def _continued(spark: SparkSession, lines: DataFrame, files: list[str]) -> DataFrame:
    """(_id, _start) of the lines that belong to records of several lines; frozen in the shared folder."""
    a, b = ends_inside(F.col("_line"))
    work = scratch_path(spark, "csv_lines")
    mapped = lines.filter(F.col("_path").isin(files)).select("_path", "_block", "_id", a.alias("_a"), b.alias("_b"))
    _before(mapped, ["_path", "_block"], "_id").write.parquet(work)
    inner = spark.read.parquet(work)
    # one row per split: its map, and then the state it starts in
    after = lambda s: F.when(F.coalesce("_set", F.pmod(F.lit(s) + F.col("_odd"), F.lit(2))) == 0, F.col("_a")).otherwise(F.col("_b"))
    splits = inner.groupBy("_path", "_block").agg(F.max_by(after(0), "_id").alias("_a"), F.max_by(after(1), "_id").alias("_b"))
    by_file = Window.partitionBy("_path").orderBy("_block")
    started = (_before(splits, ["_path"], "_block").select("_path", "_block", F.coalesce("_set", "_odd").alias("_from"))
               .withColumn("_next", F.lead("_from", 1, 0).over(by_file)))
    in_split = Window.partitionBy("_path", "_block").orderBy("_id")
    state = F.coalesce("_set", F.pmod(F.col("_from") + F.col("_odd"), F.lit(2)))
    stated = (inner.join(started, ["_path", "_block"])
              .select("_path", "_block", "_id", "_next", state.alias("_state"))
              .withColumn("_then", F.coalesce(F.lead("_state").over(in_split), F.col("_next")))
              .withColumn("_start", F.last(F.when(F.col("_state") == 0, F.col("_id")), ignorenulls=True).over(in_split)))
    # the last record start of every split, for the lines that go on with it in a later one
    last = stated.groupBy("_path", "_block").agg(F.max(F.when(F.col("_state") == 0, F.col("_id"))).alias("_last"))
    carried = last.select("_path", "_block", F.last("_last", ignorenulls=True).over(
        by_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    checkpoint_root(spark)
    out = (stated.filter((F.col("_state") == 1) | (F.col("_then") == 1)).join(carried, ["_path", "_block"])
           .select("_id", F.coalesce("_start", "_carried").alias("_start")).checkpoint(eager=True))
    paths.remove(spark, work)
    return out


def csv_records(spark: SparkSession, folder: str, glob: str, file_name: Column) -> DataFrame:
    """``file_name, record, first``: the records of every file as text, ``first`` marking each file's first.

    Empty lines between records are no records.
    """
    lines = _lines(spark, folder, glob, file_name)
    opening, _ = ends_inside(F.col("_line"))
    # one row per file: whether any of its lines leaves a field open, and its first line that is not empty
    per_file = (lines.groupBy("_path").agg(
        F.max(opening).alias("opens"),
        F.min(F.when(F.col("_line") != "", F.struct("_block", "_id"))).alias("head")).collect())
    files = [r["_path"] for r in per_file if r["opens"]]
    # a file's first record starts in the first line that is not empty: no field is open before it
    firsts = F.col("_id").isin([r["head"]["_id"] for r in per_file if r["head"]])
    whole = lines
    joined = None
    if files:
        parts = _continued(spark, lines, files)
        whole = lines.join(parts, "_id", "left_anti")
        joined = (lines.join(parts, "_id").groupBy("_path", "file_name", "_start")
                  .agg(F.array_sort(F.collect_list(F.struct("_id", "_line"))).alias("_lines"))
                  .select("file_name", F.array_join(F.col("_lines._line"), "\n").alias("record"), F.col("_start").alias("_id")))
    records = whole.filter(F.col("_line") != "").select("file_name", F.col("_line").alias("record"), "_id")
    if joined is not None:
        records = records.unionByName(joined)
    return records.select("file_name", "record", firsts.alias("first"))
