"""Exact size of a DataFrame, to decide whether it may be broadcast.

One aggregate returns the row count and the data bytes: the byte length of
every string / binary value plus the fixed width of every other value. A
side is broadcast only when both are under their limits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType,
                               DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

# Broadcast limits used unless a caller passes its own.
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def _fixed_width(t: DataType) -> int | None:
    if isinstance(t, (BooleanType, ByteType)):
        return 1
    if isinstance(t, ShortType):
        return 2
    if isinstance(t, (IntegerType, FloatType, DateType)):
        return 4
    if isinstance(t, (LongType, DoubleType, TimestampType, TimestampNTZType)):
        return 8
    if isinstance(t, DecimalType):
        return 16
    return None


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: string/binary lengths, fixed widths of scalar columns,
    and the JSON text length of nested values."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        width = _fixed_width(f.dataType)
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint"))
        elif width is not None:
            parts.append(F.lit(width).cast("bigint"))
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("bigint"))
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0).cast("bigint")


def size_metrics(df: DataFrame) -> list[Column]:
    """Aggregate columns ``rows`` and ``bytes`` (for ``agg`` or ``observe``)."""
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("bytes")]


def measure(df: DataFrame) -> tuple[int, int]:
    r = df.agg(*size_metrics(df)).first()
    return int(r["rows"]), int(r["bytes"])


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def observed(obs: Observation, *names: str) -> dict[str, int]:
    """The named counts of a finished write.

    Adaptive execution drops a stage whose rows turn out not to matter (it feeds an exchange that
    came out empty), and its observation with it; such counts are given as 0.
    """
    try:
        found = obs.get
    except AssertionError:  # the observed node was dropped from the plan that ran
        found = {}
    return {n: int(found.get(n) or 0) for n in names}
