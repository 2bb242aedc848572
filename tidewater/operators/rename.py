"""Column routing: rename mapped columns in one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def rename_columns(df: DataFrame, mapping: Mapping[str, str], only_mapped: bool = False) -> DataFrame:
    """Rename the mapped columns present in ``df``, all at once.

    Unmapped columns pass through (or are dropped with ``only_mapped``),
    column order is kept, mapped names absent from ``df`` are ignored, and
    names match case-insensitively. Two outputs with one name raise.
    """
    lower = {k.lower(): v for k, v in mapping.items()}
    cols, names = [], []
    for c in df.columns:
        new = lower.get(c.lower())
        if new is None:
            if only_mapped:
                continue
            new = c
        cols.append(F.col(f"`{c}`").alias(new))
        names.append(new)
    seen: set[str] = set()
    for n in names:
        if n.lower() in seen:
            raise ValueError(f"column mapping produces duplicate column {n!r}")
        seen.add(n.lower())
    return df.select(*cols)


def select_mapped(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return rename_columns(df, mapping, only_mapped=True)
