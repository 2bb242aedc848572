"""Keep one row per key: the first or the last in a given order.

Written as ``min_by`` / ``max_by`` aggregates rather than ``row_number``
windows: the aggregate runs a partial step before the shuffle, so a key
holding a large share of the rows collapses to one row per map task
instead of landing whole in one reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewater.functions.order import sort_key


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: bool) -> DataFrame:
    if not order:
        raise ValueError("an explicit order is needed to choose the surviving row")
    rest = [c for c in df.columns]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    ordk = F.struct(*[sort_key(df, c) for c in order])
    agg = F.min_by(row, ordk) if first else F.max_by(row, ordk)
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(agg.alias("_row"))
    return picked.select(*[F.col(f"_row.`{c}`").alias(c) for c in rest])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row per key in ``order`` (which must be total within a key)."""
    return _pick(df, keys, order, first=True)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key in ``order``: the version an ordered upsert leaves behind."""
    return _pick(df, keys, order, first=False)
