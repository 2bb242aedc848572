"""Types of CSV columns: the narrowest type that holds every value, found by one aggregate.

Each value is put on a lattice of kinds::

    int < long < decimal < double        date < timestamp        boolean        text above all

as one bit, so that the kinds of a column are the bitwise OR of its values': it is combined before the shuffle, and the
number of files, headers and columns adds rows to one job, not jobs. The join of the bits is the column's type.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
                               TimestampType)

INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
# Spellings of numbers that are no digits.
NO_DIGITS = ("NaN", "Inf", "+Inf", "-Inf", "Infinity", "+Infinity", "-Infinity")
_WHOLE = r"^[+-]?[0-9]+$"
_REAL = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?$"


def kind_of(value: Column) -> Column:
    """The bit of a value's kind; 0 for no value."""
    return (F.when(value.isNull(), 0)
            .when(value.rlike(_WHOLE), F.when(value.try_cast("int").isNotNull(), INT).when(value.try_cast("long").isNotNull(), LONG)
                  .when(value.try_cast("decimal(38,0)").isNotNull(), DECIMAL).otherwise(DOUBLE))
            .when(value.rlike(_REAL) | value.isin(*NO_DIGITS), DOUBLE)
            .when(value.rlike(_DAY) & value.try_cast("date").isNotNull(), DATE)
            .when(value.rlike(_INSTANT) & value.try_cast("timestamp").isNotNull(), TIMESTAMP)
            .when(F.lower(value).isin("true", "false"), BOOLEAN)
            .otherwise(TEXT))


def type_of(kinds: int) -> DataType:
    """The narrowest type for a set of kinds; text for none."""
    numbers = INT | LONG | DECIMAL | DOUBLE
    if kinds and not kinds & ~numbers:
        top = max(k for k in (INT, LONG, DECIMAL, DOUBLE) if kinds & k)
        return {INT: IntegerType(), LONG: LongType(), DECIMAL: DecimalType(38, 0), DOUBLE: DoubleType()}[top]
    if kinds and not kinds & ~(DATE | TIMESTAMP):
        return TimestampType() if kinds & TIMESTAMP else DateType()
    return BooleanType() if kinds == BOOLEAN else StringType()
