"""Event contract check with a reject reason per message.

The contract (fixed): the message is a JSON object; ``event_id``,
``user_id`` and ``timestamp`` are present and are strings; ``payload``,
when present, is an object (an explicit null fails). Other fields are
allowed. Checks run on VARIANT types, so a number is never mistaken for
a string, and an absent field is told apart from a JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.json import evaluate_once, field_kind

# Reject reasons, in the order they are tested.
NOT_OBJECT = "not_object"
BAD_EVENT_ID = "bad_event_id"
BAD_USER_ID = "bad_user_id"
BAD_TIMESTAMP_TYPE = "bad_timestamp_type"
BAD_PAYLOAD = "bad_payload"
BAD_TIMESTAMP = "bad_timestamp"          # well-typed text that is not a date-time (at load)

REQUIRED_STRINGS = ("event_id", "user_id", "timestamp")
OPTIONAL_OBJECT = "payload"


def reject_reason(kind: Column, field_kinds: dict[str, Column], payload_text: Column) -> Column:
    """NULL for a conforming message, else the first failed rule.

    ``kind`` is the root JSON kind, ``field_kinds`` the Spark type names of
    the required fields (NULL when absent) and ``payload_text`` the payload
    as JSON text (NULL when absent, ``null`` for an explicit JSON null).
    """
    reason = F.when(kind != "object", F.lit(NOT_OBJECT))
    for name, code in zip(REQUIRED_STRINGS, (BAD_EVENT_ID, BAD_USER_ID, BAD_TIMESTAMP_TYPE)):
        reason = reason.when(F.coalesce(field_kinds[name] != "STRING", F.lit(True)), F.lit(code))
    return reason.when(payload_text.isNotNull() & ~payload_text.startswith("{"), F.lit(BAD_PAYLOAD))


FIELDS = ("event_id", "user_id", "ts_text", "payload", "user_name", "user_location")


def validate_messages(decoded: DataFrame, v_col: str = "v", kind_col: str = "kind") -> DataFrame:
    """Decoded messages with ``reason`` and the sink fields; VARIANT dropped.

    Undecodable messages (``v`` NULL) are left out. Fields are strings,
    ``payload`` is JSON text. Everything read from the VARIANT is computed
    once per message; the reason is then a comparison of plain columns.
    """
    v = F.col(v_col)
    keep = [c for c in decoded.columns if c not in (v_col, kind_col)]
    ok = decoded.where(v.isNotNull())

    def s(name):
        return F.try_variant_get(v, f"$.{name}", "string")

    extracted = [s("event_id").alias("event_id"), s("user_id").alias("user_id"),
                 s("timestamp").alias("ts_text"),
                 F.to_json(F.try_variant_get(v, f"$.{OPTIONAL_OBJECT}", "variant")).alias("payload"),
                 s("user_name").alias("user_name"), s("user_location").alias("user_location")]
    kinds = [field_kind(v, n).alias(f"_kind_{n}") for n in REQUIRED_STRINGS]
    once = evaluate_once(ok, [*keep, kind_col], [*extracted, *kinds])
    reason = reject_reason(F.col(kind_col), {n: F.col(f"_kind_{n}") for n in REQUIRED_STRINGS},
                           F.col("payload"))
    return once.select(*keep, reason.alias("reason"), *FIELDS)


def validation_stats(validated: DataFrame) -> DataFrame:
    """Valid / invalid message counts by reason (``valid`` for accepted ones)."""
    return (validated.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("messages")))
