"""Typed high-water marks.

A mark is stored as text plus the Spark SQL type name, so one control
table can hold number, date, timestamp and string marks. The text is
turned back into a typed literal, which Catalyst folds and pushes into
the source scan (parquet ``PushedFilters`` / JDBC ``WHERE``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (DataType, DateType, TimestampNTZType, TimestampType)

# Text layouts of temporal marks.
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
DATE_FORMAT = "yyyy-MM-dd"


@dataclass(frozen=True)
class Mark:
    value: str
    type: str            # Spark SQL simple type name: bigint, double, timestamp_ntz, ...

    def literal(self) -> Column:
        return F.lit(self.value).cast(self.type)

    @staticmethod
    def of(v: object, type_name: str | None = None) -> Mark | None:
        """A mark from a Python value (None -> no mark)."""
        if v is None:
            return None
        if isinstance(v, Mark):
            return v
        if type_name is None:
            if isinstance(v, bool):
                type_name = "boolean"
            elif isinstance(v, int):
                type_name = "bigint"
            elif isinstance(v, float):
                type_name = "double"
            elif isinstance(v, _dt.datetime):
                type_name = "timestamp" if v.tzinfo else "timestamp_ntz"
            elif isinstance(v, _dt.date):
                type_name = "date"
            else:
                type_name = "string"
        if isinstance(v, _dt.datetime):
            text = v.isoformat()
        elif isinstance(v, _dt.date):
            text = v.isoformat()
        else:
            text = str(v)
        return Mark(text, type_name)


def encode_mark(c: Column, dtype: DataType) -> Column:
    """Canonical text of a typed mark column (inverse of ``Mark.literal``)."""
    if isinstance(dtype, TimestampNTZType):
        return F.date_format(c, TS_NTZ_FORMAT)
    if isinstance(dtype, TimestampType):
        return F.date_format(c, TS_FORMAT)
    if isinstance(dtype, DateType):
        return F.date_format(c, DATE_FORMAT)
    return c.cast("string")
