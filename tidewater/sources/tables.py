"""Relational sources: full, incremental and initial extracts.

The extract is a logical plan, not a cursor: the mark predicate is a
typed literal comparison on the bare incremental column, so Catalyst
pushes it into the scan (parquet row-group skipping, JDBC ``WHERE``).
Order of the extract matters only for "latest version per key", so it
is carried by the incremental column itself, never by a global sort.
"""

from __future__ import annotations

import decimal
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from tidewater import paths
from tidewater.functions.marks import Mark
from tidewater.sources.ranges import equi_depth_borders, range_predicates


def path_exists(spark: SparkSession, location: str) -> bool:
    """Whether a file path (or glob) matches anything, checked on the file system."""
    return paths.matches(spark, location)


def read_table(spark: SparkSession, location: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """A source table: a parquet/ORC/... path, a catalog table, or JDBC.

    A file source whose path matches nothing raises ``FileNotFoundError``.
    """
    opts = dict(options or {})
    if fmt == "table":
        return spark.read.table(location)
    if fmt == "jdbc":
        opts.setdefault("dbtable", location)
        return spark.read.format("jdbc").options(**opts).load()
    if not path_exists(spark, location):
        raise FileNotFoundError(location)
    return spark.read.format(fmt).options(**opts).load(location)


def jdbc_options(url: str, *, partition_column: str | None = None,
                 lower_bound: object = None, upper_bound: object = None,
                 num_partitions: int | None = None, fetchsize: int | None = None,
                 **extra: str) -> dict[str, str]:
    """Reader options for a partitioned JDBC scan.

    A chunk of the row-at-a-time original becomes a range of
    ``partition_column``: each range is read by its own task, in parallel.
    Credentials are passed through untouched and never logged.
    """
    opts = {"url": url, **{k: str(v) for k, v in extra.items()}}
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound, num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if fetchsize:
        opts["fetchsize"] = str(fetchsize)
    return opts


# JDBC URL layouts and drivers for the two database kinds of the
# settings file ([oracle]: user, password, dsn; [mysql]: user, password, host,
# port, database).
JDBC_KINDS = {
    "oracle": ("jdbc:oracle:thin:@//{dsn}", "oracle.jdbc.OracleDriver"),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver"),
}


def connection_options(section: Mapping[str, str], kind: str, **extra: str) -> dict[str, str]:
    """Spark JDBC options from a ``[oracle]`` or ``[mysql]`` settings section.

    The driver jar must be on the cluster's classpath; credentials are passed
    through as options and never logged.
    """
    if kind not in JDBC_KINDS:
        raise ValueError(f"unknown database kind {kind!r}")
    url, driver = JDBC_KINDS[kind]
    values = {k.lower(): str(v) for k, v in section.items()}
    values.setdefault("port", "3306")
    opts = {"url": url.format(**values), "driver": driver}
    for key in ("user", "password"):
        if key in values:
            opts[key] = values[key]
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def jdbc_range_options(url: str, column: str, lower_bound: int, upper_bound: int,
                       chunk_size: int | None, **extra: str) -> dict[str, str]:
    """Partitioned JDBC read with about ``chunk_size`` key values per range.

    ``chunk_size`` None (or 0) reads one range. The bounds usually come from
    a ``SELECT min(col), max(col)`` read through the same connection.
    """
    span = max(int(upper_bound) - int(lower_bound) + 1, 1)
    # sparse keys make few rows per range: beyond MAX_RANGES the ranges get wider instead
    parts = min(MAX_RANGES, max(1, -(-span // chunk_size))) if chunk_size else 1
    if parts == 1:
        return jdbc_options(url, **extra)
    return jdbc_options(url, partition_column=column, lower_bound=lower_bound,
                        upper_bound=int(upper_bound) + 1, num_partitions=parts,
                        fetchsize=min(chunk_size, 10000), **extra)


# Read ranges of one JDBC scan at most; more would each cost a connection.
MAX_RANGES = 10_000


def jdbc_bounds(spark: SparkSession, options: Mapping[str, str], column: str) -> tuple[int, int] | None:
    """Smallest and largest value of ``column``, by one query through the same connection."""
    opts = {k: v for k, v in options.items() if k not in ("dbtable", "query")}
    table = options.get("dbtable") or f"({options['query']}) q"
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    r = spark.read.format("jdbc").options(**opts, query=query).load().first()
    return None if r is None or r[0] is None else (r[0], r[1])


def _whole(value: object) -> bool:
    return not isinstance(value, bool) and (isinstance(value, int) or (isinstance(value, decimal.Decimal) and value == int(value)))


def chunked_options(spark: SparkSession, options: Mapping[str, str], column: str | None,
                    chunk_size: int | None) -> dict[str, str]:
    """Reader options with key ranges of ``chunk_size``; as given when there is nothing to cut by."""
    opts = dict(options)
    if not column or not chunk_size or "partitionColumn" in opts:
        return opts
    bounds = jdbc_bounds(spark, opts, column)
    if bounds is None or not all(map(_whole, bounds)):
        return opts
    url = opts.pop("url")
    return jdbc_range_options(url, column, int(bounds[0]), int(bounds[1]), chunk_size, **opts)


def read_jdbc_chunks(spark: SparkSession, options: Mapping[str, str], column: str | None, chunk_size: int | None) -> DataFrame:
    """A JDBC table in read ranges of about ``chunk_size`` rows.

    Whole-number keys are cut by width from their bounds; keys of any other type (text, time, fractions) by
    the quantiles of a sample, given to the reader as one condition per range.
    """
    opts = chunked_options(spark, options, column, chunk_size)
    plain = spark.read.format("jdbc").options(**opts).load()
    if not column or not chunk_size or "partitionColumn" in opts or "dbtable" not in opts:
        return plain
    if isinstance(plain.schema[column].dataType, IntegralType):
        return plain  # one range, or no rows
    borders = equi_depth_borders(plain, column, chunk_size)
    if not borders:
        return plain
    rest = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(opts["url"], opts["dbtable"], predicates=range_predicates(column, borders), properties=rest)


def extract(df: DataFrame, incremental_column: str | None = None,
            mark: Mark | object | None = None, upper: Mark | object | None = None,
            lookback: str | int | float | None = None) -> DataFrame:
    """Rows to move in this run.

    * no incremental column -> every row (a supplied mark is ignored);
    * incremental column, no mark -> every row, NULL and NaN marks included (initial load);
    * incremental column and mark -> rows with ``col > mark`` (ties, NULLs and NaNs excluded:
      neither ever becomes a mark, so they would be read again by every run).

    ``upper`` closes the range (``col <= upper``) so that a load and the
    mark computed for it see the same rows while the source keeps changing.
    ``lookback`` widens the lower bound to ``mark - lookback`` (an interval
    such as ``"1 hour"`` for temporal columns, a number otherwise) to pick up
    late rows; re-reading rows is safe because the upsert is idempotent.
    The bound stays a constant, so it is still pushed into the scan.
    """
    if not incremental_column:
        return df
    c = F.col(incremental_column)
    dtype = df.schema[incremental_column].dataType.simpleString()
    cond = None
    nan = F.isnan(c) if dtype in ("double", "float") else None
    m = Mark.of(mark, dtype) if mark is not None and not isinstance(mark, Mark) else mark
    if m is not None:
        low = m.literal().cast(dtype)
        if lookback is not None:
            low = (low - F.expr(f"INTERVAL {lookback}") if isinstance(lookback, str)
                   else low - F.lit(lookback)).cast(dtype)
        cond = c > low
        if nan is not None:
            cond = cond & ~nan
    u = Mark.of(upper, dtype) if upper is not None and not isinstance(upper, Mark) else upper
    if u is not None:
        bound = c <= u.literal().cast(dtype)
        if m is None:
            bound = bound | c.isNull()
            if nan is not None:
                bound = bound | nan
        cond = bound if cond is None else cond & bound
    return df if cond is None else df.where(cond)


def chunk_stats(df: DataFrame, key: str, chunk_size: int | None) -> DataFrame:
    """Rows, min and max key per key range of ``chunk_size`` (one range when None)."""
    k = F.col(key)
    chunk = F.floor(k / F.lit(chunk_size)) if chunk_size else F.lit(0).cast("bigint")
    return (df.groupBy(chunk.alias("chunk_id"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(k).alias("min_key"),
                 F.max(k).alias("max_key")))
