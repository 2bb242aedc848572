"""Tolerant message decoding into VARIANT.

Bytes that are not UTF-8, text that is not JSON and NULL values all
decode to NULL; nothing throws, so one bad message never stops a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DataType

# JSON kind by the first character of a valid JSON text.
_KIND_BY_FIRST_CHAR = (("{", "object"), ("[", "array"), ('"', "string"), ("t", "boolean"),
                       ("f", "boolean"), ("n", "null"))


def message_text(value: Column, dtype: DataType | None = None) -> Column:
    """UTF-8 text of a message value; invalid UTF-8 -> NULL."""
    text = value.cast("string") if isinstance(dtype, BinaryType) or dtype is None else value
    return F.try_validate_utf8(text)


def decode_json(value: Column, dtype: DataType | None = None) -> Column:
    """UTF-8 check, then JSON parse to VARIANT; failure -> NULL."""
    return F.try_parse_json(message_text(value, dtype))


def text_kind(text: Column) -> Column:
    """Kind of a *valid* JSON text from its first non-blank character (no parse, no walk)."""
    first = F.regexp_extract(text, r"^\s*(\S)", 1)  # anchored: reads only leading blanks
    kind = F.when(first == F.lit(_KIND_BY_FIRST_CHAR[0][0]), F.lit(_KIND_BY_FIRST_CHAR[0][1]))
    for ch, name in _KIND_BY_FIRST_CHAR[1:]:
        kind = kind.when(first == F.lit(ch), F.lit(name))
    return kind.otherwise(F.lit("number"))


def json_kind(v: Column) -> Column:
    """Lower-case JSON kind of a VARIANT: object, array, string, number, boolean, null."""
    s = F.schema_of_variant(v)
    return (F.when(s.startswith("OBJECT"), F.lit("object"))
            .when(s.startswith("ARRAY"), F.lit("array"))
            .when(s == "STRING", F.lit("string"))
            .when(s == "BOOLEAN", F.lit("boolean"))
            .when(s == "VOID", F.lit("null"))
            .when(s.isNotNull(), F.lit("number")))


def field_kind(v: Column, name: str) -> Column:
    """Spark type name of a top-level field; absent -> NULL, JSON null -> VOID."""
    return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))


def evaluate_once(df: DataFrame, keep: Sequence[str], exprs: Sequence[Column]) -> DataFrame:
    """``keep`` columns plus ``exprs``, each evaluated exactly once per row.

    The expressions are emitted through a one-element generator. A filter
    on a generator's output is never pushed below it, so a later predicate
    on, say, a reject reason cannot be rewritten into a fresh JSON parse
    inside the scan's filter (plain projections get inlined that way).
    """
    return df.select(*keep, F.inline(F.array(F.struct(*exprs))))
