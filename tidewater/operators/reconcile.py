"""Late rows found by digests of mark ranges, without a fixed lookback.

Source and target are each brought down to one row per range of the mark (a calendar unit, or a
width of numbers): the number of rows and two order-free checksums over their columns. Both sides
aggregate before they shuffle, and only the digests meet. Ranges that differ hold rows that arrived or changed below the mark;
they come back as intervals that are pushed into the scan of the next read.

The target should hold a source row as it is (one row per key on both sides): a range whose rows have been
superseded in the target differs for ever and is read every time, which the idempotent upsert bears.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from tidewater.functions.order import sort_key

# Calendar units of ranges.
UNITS = ("hour", "day", "week", "month", "quarter", "year")


def range_start(df: DataFrame, mark: str, width: str | int | float) -> Column:
    """Where the range of a mark value starts."""
    c = F.col(f"`{mark}`")
    dtype = df.schema[mark].dataType
    if isinstance(dtype, NumericType):
        return (F.floor(c / F.lit(width)) * F.lit(width)).cast(dtype)
    if width not in UNITS:
        raise ValueError(f"a range of {dtype.simpleString()} marks is one of {UNITS}, not {width!r}")
    return F.date_trunc(width, c).cast(dtype)


def range_digests(df: DataFrame, mark: str, width: str | int | float, columns: Sequence[str]) -> DataFrame:
    """``start, n, x, s``: rows and order-free checksums of the rows of each mark range."""
    h = F.xxhash64(*[sort_key(df, c) for c in columns])
    return (df.where(F.col(f"`{mark}`").isNotNull()).select(range_start(df, mark, width).alias("start"), h.alias("h"))
            .groupBy("start").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"),
                                  F.sum(F.pmod("h", F.lit(1 << 31))).alias("s")))


def differing_ranges(source: DataFrame, target: DataFrame, mark: str, width: str | int | float) -> list[tuple]:
    """``(start, end)`` of the ranges, neighbours joined, in which ``source`` has rows that ``target`` lacks or has otherwise.

    ``end`` is exclusive. One row per differing range reaches the driver.
    """
    columns = list(source.columns)
    there = target.select(*[F.col(f"`{c}`").cast(source.schema[c].dataType).alias(c) for c in columns])
    ours = range_digests(source, mark, width, columns)
    theirs = range_digests(there, mark, width, columns).select("start", *[F.col(c).alias(f"t_{c}") for c in ("n", "x", "s")])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ("n", "x", "s")])
    if isinstance(source.schema[mark].dataType, NumericType):
        end = F.col("start") + F.lit(width)
    else:
        months = {"quarter": 3, "year": 12}.get(width)
        end = F.col("start") + F.expr(f"INTERVAL {months} MONTH" if months else f"INTERVAL 1 {width.upper()}")
    rows = ours.join(theirs, "start", "left").where(~same).select("start", end.cast(source.schema[mark].dataType).alias("end")).collect()
    out: list[list] = []
    for start, stop in sorted(map(tuple, rows)):
        if out and out[-1][1] == start:
            out[-1][1] = stop
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def in_ranges(column: Column, ranges: Sequence[tuple]) -> Column:
    """Whether a mark lies in one of the intervals; bare comparisons, so that scans can skip by them."""
    parts = [(column >= F.lit(lo)) & (column < F.lit(hi)) for lo, hi in ranges]
    while len(parts) > 1:  # a balanced tree: many intervals do not make a deep expression
        parts = [reduce(lambda a, b: a | b, parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0] if parts else F.lit(False)
