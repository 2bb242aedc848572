"""CSV and text folders.

A folder is read as one DataFrame whose rows carry the file they came
from (``_metadata.file_name``). Only names ending in lower-case ``.csv``
are taken, without descending into sub-folders.
"""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tidewater import paths
from tidewater.sources.csv_records import csv_fields, csv_records
from tidewater.sources.csv_types import kind_of, type_of
from tidewater.sources.tables import path_exists

# The file-name filter of the folder jobs.
CSV_GLOB = "*.csv"


def _single_file(spark: SparkSession, tmp_dir: str, dest: str, suffix: str) -> None:
    parts = [full for name, full, _ in paths.list_dir(spark, tmp_dir)
             if name.startswith("part-") and name.endswith(suffix)]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {tmp_dir}, found {len(parts)}")
    paths.move(spark, parts[0], dest)
    paths.remove(spark, tmp_dir)


def export_csv(df: DataFrame, folder: str, name: str, order_by: list[str] | None = None,
               header: bool = True) -> str:
    """Write a small DataFrame as the single file ``folder/name`` (fixtures only)."""
    spark = df.sparkSession
    tmp = f"{folder.rstrip('/')}/_tmp_{name}"
    one = df.repartition(1)
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    one.write.mode("overwrite").option("header", header).csv(tmp)
    dest = f"{folder.rstrip('/')}/{name}"
    _single_file(spark, tmp, dest, ".csv")
    return dest


def export_text(df: DataFrame, folder: str, name: str, order_by: list[str] | None = None) -> str:
    """Write a one-string-column DataFrame as the single text file ``folder/name``."""
    spark = df.sparkSession
    tmp = f"{folder.rstrip('/')}/_tmp_{name}"
    one = df.repartition(1)
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    value = [c for c in one.columns if c not in (order_by or [])]
    one.select(F.col(value[0]).alias("value")).write.mode("overwrite").text(tmp)
    dest = f"{folder.rstrip('/')}/{name}"
    _single_file(spark, tmp, dest, ".txt")
    return dest


def export_lines(df: DataFrame, folder: str, stem: str) -> list[str]:
    """Write a one-string-column DataFrame as text files ``stem_<i>.csv``, one per partition."""
    spark = df.sparkSession
    tmp = f"{folder.rstrip('/')}/_tmp_{stem}"
    df.write.mode("overwrite").text(tmp)
    parts = sorted(full for name, full, _ in paths.list_dir(spark, tmp) if name.startswith("part-"))
    out = [f"{folder.rstrip('/')}/{stem}_{i}.csv" for i in range(len(parts))]
    for part, dest in zip(parts, out, strict=True):
        paths.move(spark, part, dest)
    paths.remove(spark, tmp)
    return out


def export_csv_split(df: DataFrame, folder: str, stem: str, key: str,
                     rows_per_file: int) -> list[str]:
    """Write ``df`` as ``stem_<r>.csv`` files, r = key mod n, n growing with the rows.

    Each file is written by its own task (rows sorted by ``key``), so the
    export runs in parallel however large the table is.
    """
    spark = df.sparkSession
    n = max(1, -(-df.count() // rows_per_file))
    tmp = f"{folder.rstrip('/')}/_tmp_{stem}"
    (df.withColumn("_f", F.pmod(F.col(key), F.lit(n))).repartition(n, "_f")
     .sortWithinPartitions("_f", key).write.mode("overwrite").option("header", True)
     .partitionBy("_f").csv(tmp))
    out = []
    for name, full, is_dir in paths.list_dir(spark, tmp):
        if is_dir and name.startswith("_f="):
            dest = f"{folder.rstrip('/')}/{stem}_{name[3:]}.csv"
            _single_file(spark, full, dest, ".csv")
            out.append(dest)
    paths.remove(spark, tmp)
    return sorted(out)


def csv_files(spark: SparkSession, folder: str) -> list[str]:
    """The ``*.csv`` files directly inside ``folder`` (a driver-side listing)."""
    return sorted(full for name, full, is_dir in paths.list_dir(spark, folder)
                  if not is_dir and name.endswith(".csv") and name[0] not in "_.")


def _file_name() -> Column:
    # the metadata column is percent-encoded; a plus sign in it is a plus sign
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file_name")


def read_csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, fields)``: every record of every CSV file, ragged, header treated as data.

    Files are read in splits by many tasks, whatever their quoting (``csv_records``). Empty fields are empty
    strings. Blank lines are no records.
    """
    return csv_records(spark, folder, CSV_GLOB, _file_name()).select("file_name", csv_fields(F.col("record")).alias("fields"))


def read_csv_folder_raw(spark: SparkSession, folder: str, width: int | None = None) -> DataFrame:
    """Every record of every CSV file as strings, header treated as data.

    Columns are ``file_name, _c0 .. _c{width-1}``; short rows are padded
    with NULL, an empty field stays an empty string. ``width`` defaults to the
    widest record of all files (one distributed pass over the rows). With a
    given ``width`` a wider record fails the read rather than losing its extra
    fields.
    """
    if not csv_files(spark, folder):
        return spark.createDataFrame([], "file_name string")
    records = read_csv_records(spark, folder)
    if width is None:
        width = records.agg(F.max(F.size("fields"))).first()[0] or 0
    names = [f"_c{i}" for i in range(width)]
    if not names:
        return records.select("file_name")
    cols = [F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(names)]
    wider = F.when(F.size("fields") > width, F.raise_error(F.lit(f"CSV row wider than {width} fields; pass width=")))
    return records.select("file_name", *cols[:-1], F.coalesce(wider, cols[-1]).alias(names[-1]))


def _safe_names(header: Column) -> Column:
    """Column names of a header: a missing one is ``_c<i>``, and ones that come twice get their place."""
    lower = F.transform(header, lambda x: F.lower(F.coalesce(x, F.lit(""))))
    twice = lambda x: F.size(F.filter(lower, lambda y: y == F.lower(x))) > 1
    return F.transform(header, lambda x, i: F.when(F.coalesce(x, F.lit("")) == "", F.concat(F.lit("_c"), i))
                       .when(twice(x), F.concat(x, i)).otherwise(x))


def read_csv_folder_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Each CSV with its own header and inferred types, aligned by column name (in any case).

    One job finds all column names and, of every column over all files, the narrowest type that holds its
    values (``csv_types``). A field without any character is NULL, a quoted empty one is the empty string; missing
    fields are NULL, and fields beyond the header are dropped. Columns come in the order of files and headers.
    """
    files = csv_files(spark, folder)
    if not files:
        return spark.createDataFrame([], "file_name string")
    # headers go to the records: a join by file name would bring each file to one task
    to_all = F.broadcast if len(files) <= MAX_BROADCAST_SPLITS else lambda df: df
    records = csv_records(spark, folder, CSV_GLOB, _file_name()).select(
        "file_name", "first", csv_fields(F.col("record"), F.lit(None).cast("string")).alias("_fields"))
    heads = records.filter("first").select("file_name", _safe_names(F.col("_fields")).alias("_header"))
    rows = records.filter("not first").select("file_name", "_fields").join(to_all(heads), "file_name")
    kinds = F.transform("_header", lambda name, i: F.struct(
        F.lower(name).alias("column"), kind_of(F.get("_fields", i)).alias("kind")))
    seen = rows.select(F.inline(kinds)).groupBy("column").agg(F.bit_or("kind").alias("kinds"))
    named = (heads.select("file_name", F.posexplode("_header").alias("at", "name"))
             .groupBy(F.lower("name").alias("column")).agg(F.min(F.struct("file_name", "at", "name")).alias("at")))
    found = named.join(seen, "column", "left").select("column", "at.*", "kinds").collect()  # one row per column
    found.sort(key=lambda r: (r["file_name"], r["at"]))
    columns = F.array(*[F.lit(r["column"]) for r in found])
    lower = F.transform("_header", lambda x: F.lower(x))
    # where each column of the result lies in a file's records, once per file; get() gives NULL outside a record
    placed = heads.select("file_name", F.transform(columns, lambda c: (F.array_position(lower, c) - 1).cast("int")).alias("_places"))
    return records.filter("not first").join(to_all(placed), "file_name").select("file_name", *[
        F.get("_fields", F.get("_places", F.lit(i))).cast(type_of(r["kinds"] or 0)).alias(r["name"]) for i, r in enumerate(found)])


_WHOLE_SCHEMA = StructType([StructField("file_name", StringType()),
                            StructField("found", BooleanType()),
                            StructField("content", StringType())])


def read_text_whole(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``(file_name, found, content)``: the whole text of ``folder/name``.

    An absent file (or folder) is reported as ``found = false``, not raised.
    """
    text = None
    if path_exists(spark, folder):
        try:
            text = (spark.read.option("pathGlobFilter", name)
                    .text(folder, wholetext=True).select(_file_name(), F.col("value").alias("content")))
        except AnalysisException:
            text = None
    if text is None:
        text = spark.createDataFrame([], "file_name string, content string")
    want = spark.createDataFrame([(name,)], "file_name string")
    return (want.join(text, "file_name", "left")
            .select("file_name", F.col("content").isNotNull().alias("found"), "content"))


# Split tables up to this many rows are broadcast into the line numbering.
MAX_BROADCAST_SPLITS = 1_000_000


def read_text_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(file_name, line_no, line)`` with line numbers from 0 in file order.

    Files are read in splits by many tasks, never whole. Within a split the
    rows keep file order, so a line's number is its position in the split
    (from ``monotonically_increasing_id``, which counts rows within a
    partition) plus the lines of the earlier splits of the same file (from a
    table with one row per split). That table is broadcast when its size
    bound (files + partitions) allows.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(path)
    raw = text.select(F.col("_metadata.file_path").alias("_path"),
                      _file_name(),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_id"),
                      F.col("value").alias("line"))
    splits = raw.groupBy("_path", "_block").agg(F.min("_id").alias("_first"),
                                                F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_path").orderBy("_block")) - F.col("_n")
    splits = splits.select("_path", "_block", "_first", before.alias("_before"))
    # a split is no smaller than the file's share of the split size, and a file has one at least
    bound = splits_bound(spark, path, glob)
    if bound <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    lines = raw.join(splits, ["_path", "_block"])
    return lines.select("file_name", (F.col("_id") - F.col("_first") + F.col("_before"))
                        .cast("bigint").alias("line_no"), "line")


def splits_bound(spark: SparkSession, path: str, glob: str | None = None) -> int:
    """An upper bound on the splits that reading ``path`` makes, from file sizes alone."""
    size = paths.sizes(spark, path)
    conf = spark._jsparkSession.sessionState().conf()
    least = max(1, min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes()))  # no split but a file's last is smaller
    return sum(1 + n // least for n in size)


def base_name(path: str) -> str:
    return posixpath.basename(path.rstrip("/"))
