"""Order and comparison keys for columns of any type.

MAP and VARIANT values can be neither ordered nor compared by Spark; their JSON
text stands for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def orderable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return orderable(t.elementType)
    return all(orderable(f.dataType) for f in t.fields) if isinstance(t, StructType) else True


def sort_key(df: DataFrame, column: str) -> Column:
    """The column itself, or its JSON text where its values have no order."""
    c = F.col(f"`{column}`")
    return c if orderable(df.schema[column].dataType) else F.to_json(F.struct(c))
