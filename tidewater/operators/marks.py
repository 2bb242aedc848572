"""High-water marks: batch maximum, fold with the old mark, commit gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tidewater.functions.coerce import try_number


def batch_max(df: DataFrame, column: str, numeric: bool = False) -> Column:
    """NULL-skipping maximum of the incremental column.

    NaN is skipped (Spark ranks it above every number). With ``numeric``
    the values are coerced to DOUBLE first and non-numeric ones ignored.
    """
    c = F.col(f"`{column}`")
    dtype = df.schema[column].dataType
    if numeric and not isinstance(dtype, NumericType):
        return F.max(try_number(c))
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.max(F.when(~F.isnan(c), c))
    return F.max(c)


def fold_mark(old: Column, new: Column) -> Column:
    """The larger of the previous mark and this batch's maximum (NULLs skipped)."""
    return F.greatest(old, new)


def commit_gate(metrics: DataFrame) -> DataFrame:
    """Decide the mark to keep per table.

    ``metrics`` columns: ``table_name, incremental_column, old_mark,
    new_mark, rows, failed`` (marks as canonical text). The mark advances
    only when the table is incremental, nothing failed, at least one row
    was read and the new mark is set and differs from the old; otherwise
    the old mark stays.
    """
    advance = (F.col("incremental_column").isNotNull() & (F.col("failed") == 0)
               & (F.col("rows") > 0) & F.col("new_mark").isNotNull()
               & ~F.col("new_mark").eqNullSafe(F.col("old_mark")))
    return metrics.select("*", F.when(advance, F.col("new_mark")).otherwise(F.col("old_mark"))
                          .alias("mark"), advance.alias("advanced"))
