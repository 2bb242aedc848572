"""Null-safe coercions (ANSI mode is on, so every cast is a ``try_``)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def try_number(c: Column | str) -> Column:
    """Text or number -> DOUBLE; anything unparsable (or NaN) -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    d = F.try_cast(c, "double") if hasattr(F, "try_cast") else c.try_cast("double")
    return F.when(~F.isnan(d), d)


# A full ISO 8601 date-time: day and time of day, with or without seconds, fraction and offset.
ISO_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})?$"


def try_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Text -> TIMESTAMP; anything else than a full ISO date-time -> NULL.

    Spark's own cast takes more: a time alone becomes today, a year alone its first day.
    """
    c = F.col(c) if isinstance(c, str) else c
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt))
    return F.when(c.rlike(ISO_DATE_TIME), F.try_to_timestamp(F.upper(c)))


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rewrite NaN to NULL in floating columns, keeping order and names."""
    wanted = set(columns) if columns is not None else None
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)) and (wanted is None or f.name in wanted):
            c = F.when(~F.isnan(c), c).alias(f.name)
        out.append(c)
    return df.select(*out)


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL (and NaN for floating columns) -> default, per column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in defaults:
            v = F.lit(defaults[name])
            if isinstance(types[name], (DoubleType, FloatType)):
                c = F.when(F.isnan(c), v).otherwise(F.coalesce(c, v))
            else:
                c = F.coalesce(c, v.cast(types[name]))
            c = c.alias(name)
        out.append(c)
    return df.select(*out)
