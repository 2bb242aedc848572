"""Targets in key buckets whose files carry key statistics: an upsert rewrites only files it has to.

Rows live in files ``root/data/<run>/_bucket=<b>/...`` with ``b = pmod(xxhash64(keys), n)``, sorted by key
inside a file. The manifest (a small versioned table) has one row per file: bucket, path, rows, smallest and
largest key, and where its key filter lies; one more row holds the layout (number of buckets, keys with their types,
the table's schema). The key filters are blocked Bloom filters in tables of their own (``root/index/<run>``):
a file's keys are dealt by hash to pages of at most some ``KEYS_A_PAGE`` keys, and a page has three bitmaps, one per hash.

A load joins its keys with the files of their buckets, keeps the files whose key range holds a key and whose
page says it may be there, and rewrites these; keys that no file can hold go to new files. So a batch of new keys rewrites nothing,
and an update touches the files of its keys. A bucket of the batch with ``MAX_SMALL_FILES`` files of less than a quarter of
the full size has these rewritten along, so small files do not pile up. The new files and the
untouched ones are published by one manifest version, made from the version that was read: a load that another writer overtakes
(``CommitConflict``) looks up its files again and tries once more. Readers see all of a load or nothing of
it, no file is ever overwritten. Files that only expired manifest versions name are removed by the next load; what
lost loads leave behind is removed by ``remove_leftovers``.

Buckets and keys are fixed when a table is first written; a load that names others
is refused, and key values are cast to the stored types before they are hashed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from tidewater import paths
from tidewater.functions.size import observed
from tidewater.operators.upsert import AFFECTED, NULL_ROWS, collapse_versions, load_metrics, merge_counted
from tidewater.session import checkpoint_root
from tidewater.sinks.versioned import (DEFAULT_KEEP, MAX_ATTEMPTS, CommitConflict, current_version, expire, publish,
                                       version_paths)

BUCKET_COL = "_bucket"
LAYOUT_ROW = -1  # the manifest row that only carries the layout
KEYS_A_PAGE = 9000
PAGE_BITS = 32768  # of bitmap_construct_agg
MAX_SMALL_FILES = 16
FILE_ROWS = 1_000_000
# Unpublished folders younger than this are left alone.
GRACE_SECONDS = 24 * 3600
KEEP_ALL = 1 << 30  # manifest versions expire together with their files


@dataclass(frozen=True)
class BucketedLoad:
    """What a load did; ``rewritten`` files of ``files`` that were there."""

    affected: int
    files: int
    rewritten: int
    buckets: tuple[int, ...]


def _keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*_keys(keys)), F.lit(buckets)).cast("int")


def _traits(keys: Sequence[str]) -> list[Column]:
    """What the look-up of a key takes: the key, its hash for a page and its places in the page's three bitmaps."""
    h = F.xxhash64(*_keys(keys), F.lit(2))
    return [F.struct(*_keys(keys)).alias("key"), F.xxhash64(*_keys(keys), F.lit(1)).alias("page_hash"),
            *[F.pmod(F.shiftright(h, 15 * i), F.lit(PAGE_BITS)).alias(f"at{i}") for i in range(3)]]


def _page(pages: Column) -> Column:
    return F.pmod(F.col("page_hash"), pages).cast("int").alias("page")


def _has(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), F.pmod(position, F.lit(8)))).cast("int") % 2 == 1


@dataclass(frozen=True)
class _Table:
    version: str
    layout: dict
    rows: DataFrame             # one row per file
    files: tuple[str, ...]
    indexes: tuple[str, ...]    # folders of the key filters


def _manifest(spark: SparkSession, root: str) -> _Table | None:
    """The table as its current manifest version has it; None if there is none."""
    version = current_version(spark, f"{root.rstrip('/')}/_manifest")
    if version is None:
        return None
    table = spark.read.parquet(version)
    index = F.col("index") if "index" in table.columns else F.lit(None).cast("string").alias("index")
    named = table.select("bucket", "path", index, "layout").collect()  # one row per file
    layout = json.loads(next(r["layout"] for r in named if r["bucket"] == LAYOUT_ROW))
    rows = table.filter("path is not null")
    key = _key_type(layout).simpleString()
    for name, kind in (("rows", "long"), ("lo", key), ("hi", key), ("pages", "int"), ("index", "string")):
        if name not in rows.columns:  # a manifest of whole bucket folders: no statistics
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    return _Table(version, layout, rows.select("bucket", "path", "rows", "lo", "hi", "pages", "index"),
                  tuple(sorted(r["path"] for r in named if r["path"])),
                  tuple(sorted({r["index"] for r in named if r["index"]})))


def _schema(layout: dict) -> StructType:
    return StructType.fromJson(layout["schema"])


def _key_type(layout: dict) -> StructType:
    schema = _schema(layout)
    return StructType([StructField(k, schema[k].dataType) for k in layout["keys"]])


def _read(spark: SparkSession, root: str, layout: dict, files: Sequence[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], _schema(layout))
    return spark.read.schema(_schema(layout)).parquet(*[f"{root.rstrip('/')}/{f}" for f in files])


def read_bucketed(spark: SparkSession, root: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The table (or only the given buckets); None if absent."""
    table = _manifest(spark, root)
    if table is None:
        return None
    files = table.files
    if buckets is not None:
        files = sorted(r[0] for r in table.rows.filter(F.col("bucket").isin(sorted(set(buckets)))).select("path").collect())
    return _read(spark, root, table.layout, files)


def fit_layout(source: DataFrame, root: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``source`` with its keys in the stored types; raises if the table has another layout."""
    table = _manifest(source.sparkSession, root)
    if table is None:
        return source
    layout = table.layout
    if (layout["buckets"], layout["keys"]) != (buckets, list(keys)):
        raise ValueError(f"{root} has {layout['buckets']} buckets on {layout['keys']}, not {buckets} on {list(keys)}")
    types = {f.name: f.dataType for f in _key_type(layout).fields}
    return source.withColumns({k: F.col(f"`{k}`").cast(types[k]) for k in keys if source.schema[k].dataType != types[k]})


def files_of_keys(spark: SparkSession, root: str, table: _Table, changes: DataFrame, file_rows: int = FILE_ROWS) -> list[str]:
    """Files that may hold a key of ``changes``, and the small ones of buckets that get too many of them."""
    keys = table.layout["keys"]
    asked = changes.select(bucket_of(keys, table.layout["buckets"]).alias("bucket"), *_traits(keys))
    near = asked.join(table.rows, "bucket").filter(
        F.col("lo").isNull() | ((F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi"))))
    wanted = near.filter(F.col("pages").isNull()).select("path")
    if table.indexes:
        filters = spark.read.parquet(*[f"{root}/{i}" for i in table.indexes]).select("path", "page", "bits0", "bits1", "bits2")
        tested = near.select("path", _page(F.col("pages")), "at0", "at1", "at2").join(filters, ["path", "page"])
        for i in range(3):
            tested = tested.filter(_has(F.col(f"bits{i}"), F.col(f"at{i}")))
        wanted = wanted.unionByName(tested.select("path"))
    small = table.rows.filter(F.col("rows") < file_rows / 4)
    crowded = (small.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).filter(F.col("n") >= MAX_SMALL_FILES)
               .join(asked.select("bucket").distinct(), "bucket", "left_semi").select("path"))
    return sorted(r[0] for r in wanted.unionByName(crowded).distinct().collect())  # at most one row per file


def _index(spark: SparkSession, root: str, run: str, layout: dict, file_rows: int) -> DataFrame:
    """Writes the key filters of a run's files; returns the files' manifest rows."""
    keys, pages = layout["keys"], -(-file_rows // KEYS_A_PAGE)
    name = F.concat(F.lit(f"{run}/"), F.substring_index(F.col("_metadata.file_path"), f"/{run}/", -1))
    rows = spark.read.schema(StructType([*_key_type(layout).fields, StructField(BUCKET_COL, IntegerType())])) \
        .parquet(f"{root}/{run}").select(name.alias("path"), F.col(BUCKET_COL).alias("bucket"), *_traits(keys))
    index = f"index/{run.rsplit('/', 1)[1]}"
    (rows.groupBy("bucket", "path", _page(F.lit(pages)))
     .agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("lo"), F.max("key").alias("hi"),
          *[F.bitmap_construct_agg(F.col(f"at{i}")).alias(f"bits{i}") for i in range(3)])
     .write.parquet(f"{root}/{index}"))
    return (spark.read.parquet(f"{root}/{index}").groupBy("bucket", "path")
            .agg(F.sum("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .withColumn("pages", F.lit(pages)).withColumn("index", F.lit(index)))


def merge_bucketed(changes: DataFrame, root: str, keys: Sequence[str], buckets: int, file_rows: int = FILE_ROWS,
                   add_columns: bool = False) -> BucketedLoad:
    """Apply ``changes`` (of ``collapse_versions``, keys in the stored types) to the table at ``root``."""
    spark, root, keys = changes.sparkSession, root.rstrip("/"), list(keys)
    for left in reversed(range(MAX_ATTEMPTS)):
        table = _manifest(spark, root)
        rewritten = files_of_keys(spark, root, table, changes, file_rows) if table else []
        current = _read(spark, root, table.layout, rewritten) if table else None
        if add_columns and current is not None:
            current = with_new_columns(current, changes)
        merged = merge_counted(current, changes, keys)
        if current is not None:  # untouched files keep their types, so the table does
            merged = merged.withColumns({f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in current.schema.fields
                                         if merged.schema[f.name].dataType != f.dataType})
        plain = merged.drop(AFFECTED, NULL_ROWS)
        layout = {"buckets": buckets, "keys": keys, "schema": json.loads(plain.schema.json())}
        run = f"data/{uuid.uuid4().hex}"
        obs = Observation(f"bucketed_{uuid.uuid4().hex[:8]}")
        (merged.withColumn(BUCKET_COL, bucket_of(keys, buckets)).repartition(F.col(BUCKET_COL))
         .sortWithinPartitions(BUCKET_COL, *_keys(keys)).observe(obs, *load_metrics()).drop(AFFECTED, NULL_ROWS)
         .write.option("maxRecordsPerFile", file_rows).partitionBy(BUCKET_COL).parquet(f"{root}/{run}"))
        counts = observed(obs, "affected", "null_keys")
        if counts["null_keys"]:
            paths.remove(spark, f"{root}/{run}")
            raise ValueError(f"{counts['null_keys']} rows with a NULL key")
        touched = tuple(sorted(int(name.split("=")[1]) for name, _, _ in paths.list_dir(spark, f"{root}/{run}")
                               if name.startswith(f"{BUCKET_COL}=")))
        head = spark.createDataFrame([(LAYOUT_ROW, json.dumps(layout))], "bucket int, layout string")
        rows = head
        if touched:
            rows = rows.unionByName(_index(spark, root, run, layout, file_rows), allowMissingColumns=True)
        if table:
            rows = rows.unionByName(table.rows.filter(~F.col("path").isin(rewritten)) if rewritten else table.rows,
                                    allowMissingColumns=True)
        try:
            publish(rows.coalesce(1), f"{root}/_manifest", keep=KEEP_ALL, base=table.version if table else None)
        except CommitConflict:
            paths.remove(spark, f"{root}/{run}")
            paths.remove(spark, f"{root}/index/{run.rsplit('/', 1)[1]}")
            if not left:
                raise
            continue
        _expire(spark, root)
        return BucketedLoad(counts["affected"], len(table.files) if table else 0, len(rewritten), touched)
    raise AssertionError("unreachable")


def with_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` with the columns that only ``source`` has, empty."""
    inner = ("_n", "_steps", "_first")
    return target.withColumns({c: F.lit(None).cast(source.schema[c].dataType) for c in source.columns
                               if c not in target.columns and c not in inner})


def upsert_bucketed(source: DataFrame, root: str, keys: Sequence[str], buckets: int, *,
                    order_by: Sequence[str] | None = None, file_rows: int = FILE_ROWS) -> list[int]:
    """Apply ``source`` to the bucketed table at ``root``; returns the buckets of its keys."""
    spark, keys = source.sparkSession, list(keys)
    src = fit_layout(source, root, keys, buckets)
    rest = [c for c in src.columns if c not in keys]
    checkpoint_root(spark)
    if rest:
        changes = collapse_versions(src, keys, order_by or rest, rest)
    else:
        changes = src.dropDuplicates(keys).select("*", F.lit(1).cast("long").alias("_n"), F.lit(0).cast("long").alias("_steps"),
                                                  F.lit(None).cast("string").alias("_first"))
    # read for the look-up of files and for the merge
    return list(merge_bucketed(changes.checkpoint(eager=True), root, keys, buckets, file_rows).buckets)


def _expire(spark: SparkSession, root: str) -> None:
    """Drop manifest versions beyond the newest kept ones, and the files and key filters that only they name."""
    versions = version_paths(spark, f"{root}/_manifest")
    old, kept = versions[:-DEFAULT_KEEP], versions[-DEFAULT_KEEP:]
    if not old:
        return

    def named(some: list[str]) -> tuple[set, set]:
        rows = spark.read.schema("path string, index string").parquet(*some).filter("path is not null").distinct().collect()
        return {r["path"] for r in rows}, {r["index"] for r in rows if r["index"]}  # one row per file
    (files, indexes), (used, used_indexes) = named(old), named(kept)
    runs = {f.split("/")[1] for f in used}
    for run in {f.split("/")[1] for f in files} - runs:
        paths.remove(spark, f"{root}/data/{run}")
    for path in (f for f in files - used if f.split("/")[1] in runs):
        paths.remove(spark, f"{root}/{path}")
    for index in indexes - used_indexes:
        paths.remove(spark, f"{root}/{index}")
    expire(spark, f"{root}/_manifest")


def remove_leftovers(spark: SparkSession, root: str, older_than: float = GRACE_SECONDS) -> list[str]:
    """Remove folders that lost loads have left: named by no manifest, and older than ``older_than`` seconds.

    Younger ones may belong to a load that is still to be published. For maintenance; loads do not call it.
    """
    root = root.rstrip("/")
    kept = version_paths(spark, f"{root}/_manifest")
    named = spark.read.schema("path string, index string").parquet(*kept).distinct().collect() if kept else []
    used = {"/".join(r["path"].split("/")[:2]) for r in named if r["path"]} | {r["index"] for r in named if r["index"]}
    before, gone = (time.time() - older_than) * 1000, []
    for kind in ("data", "index"):
        for run, full, _ in paths.list_dir(spark, f"{root}/{kind}"):
            if f"{kind}/{run}" not in used and paths.modified(spark, full) <= before:
                paths.remove(spark, full)
                gone.append(f"{kind}/{run}")
    return gone
