"""Read ranges of about equal numbers of rows over any key that has an order.

Equal widths of a key fit dense whole numbers only. Here the borders are quantiles of a sample: its
size is bounded by the number of ranges, it is sorted by Spark's range partitioning, and one row per range (its
smallest key) reaches the driver. Borders may differ a little from call to call. So text, time, decimal and sparse keys do as well, and a skewed key gives narrow ranges
where it is dense. Only a single value with more rows than a range holds cannot be cut further.
"""

from __future__ import annotations

import datetime as _dt
import decimal

from pyspark.sql import Column, DataFrame, functions as F

# Sampled rows per range, and ranges of a read at most (each is a task, and with JDBC a query).
SAMPLE_PER_RANGE = 400
MAX_RANGES = 10_000


def equi_depth_borders(df: DataFrame, key: str, rows_per_range: int, rows: int | None = None, seed: int = 17) -> list:
    """Inner borders, ascending: range i holds the keys from border i - 1 (inclusive) up to border i (exclusive)."""
    rows = df.count() if rows is None else rows
    ranges = min(MAX_RANGES, -(-rows // max(1, rows_per_range)))
    if ranges <= 1:
        return []
    wanted = df.select(F.col(f"`{key}`").alias("k")).where("k is not null")
    share = min(1.0, 1.2 * ranges * SAMPLE_PER_RANGE / rows)
    sample = wanted if share == 1.0 else wanted.sample(share, seed)
    lows = (sample.repartitionByRange(ranges, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("low"))
            .collect())  # one row per range
    return sorted({r["low"] for r in lows})[1:]


def sql_literal(value: object) -> str:
    """A key value as standard SQL text."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, _dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    quoted = str(value).replace("'", "''")
    return f"'{quoted}'"


def range_predicates(key: str, borders: list) -> list[str]:
    """One SQL condition per range, for a reader that takes them; every row, NULL keys too, meets exactly one."""
    if not borders:
        return ["1 = 1"]
    text = [sql_literal(b) for b in borders]
    inner = [f"{key} >= {lo} AND {key} < {hi}" for lo, hi in zip(text, text[1:], strict=False)]
    return [f"{key} < {text[0]} OR {key} IS NULL", *inner, f"{key} >= {text[-1]}"]


def range_of(key: Column, borders: list) -> Column:
    """The number of the range a key lies in; NULL keys lie in the first."""
    if not borders:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b <= key)), F.lit(0))


def range_stats(df: DataFrame, key: str, rows_per_range: int, borders: list | None = None) -> DataFrame:
    """Rows, smallest and largest key of every equi-depth range, or of the ranges given by ``borders``."""
    borders = equi_depth_borders(df, key, rows_per_range) if borders is None else borders
    k = F.col(f"`{key}`")
    return df.groupBy(range_of(k, borders).alias("range_id")).agg(F.count(F.lit(1)).alias("rows"), F.min(k).alias("min_key"),
                                                                  F.max(k).alias("max_key"))
