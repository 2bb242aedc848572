"""Topic-shaped message sources.

Messages have the Kafka source's columns (``key, value, topic,
partition, offset, timestamp``) so the live connector can be swapped in:
``spark.readStream.format("kafka").options(**kafka_options(...))``. The
Kafka connector jar is not bundled with PySpark; ``messages_from_events``
derives the same shape from the ``events`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewater.functions.json import decode_json

# The layout of the derived message corpus. Message kind is
# ``event_id % 20``; the event key is "e" || (event_id div 3) so keys repeat
# up to three times; the user key is "u" || user_id.
ISO_UTC_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
MESSAGE_KINDS = 20
BAD_TIMESTAMP_TEXT = "not a time"
PRESET_USER_NAME = "preset"
TIME_ONLY_TEXT = "12:30:00"
YEAR_ONLY_TEXT = "2024"
ISO_PLUS_TWO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"
PARTITIONS = 4


def kafka_options(bootstrap_servers: str, topic: str, *, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None, group_id: str | None = None,
                  **extra: str) -> dict[str, str]:
    """Options for ``spark.read[Stream].format("kafka")``.

    Offsets live in the query checkpoint, so they advance only after the
    sink commits; a group id is only needed for broker-side monitoring.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": "false"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_messages(spark, fmt: str = "kafka", path: str | None = None,
                  options: dict[str, str] | None = None) -> DataFrame:
    """A bounded batch of messages with the Kafka source's columns.

    For Kafka pass ``kafka_options(...)`` plus ``endingOffsets``; a file
    format reads files already holding those columns.
    """
    r = spark.read.format(fmt).options(**(options or {}))
    return r.load(path) if path else r.load()


def message_text(events: DataFrame) -> DataFrame:
    """``(seq, text)``: one JSON message per event, with faults injected by kind."""
    eid = F.col("event_id")
    k = F.concat(F.lit("e"), F.expr("event_id div 3").cast("string"))
    u = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    t = F.date_format("ts", ISO_UTC_MICROS)
    p = F.col("props")

    def q(x):
        return F.concat(F.lit('"'), x, F.lit('"'))

    def obj(*pairs):
        body = []
        for i, (name, val) in enumerate(pairs):
            body += [F.lit(("," if i else "") + f'"{name}":'), val]
        return F.concat(F.lit("{"), *body, F.lit("}"))

    full = [("event_id", q(k)), ("user_id", q(u)), ("timestamp", q(t)), ("payload", p)]
    m = eid % MESSAGE_KINDS
    text = (F.when(m == 0, F.lit("{bad"))
            .when(m == 1, F.lit("[1,2]"))
            .when(m == 2, obj(full[0], full[2], full[3]))
            .when(m == 3, obj(("event_id", F.expr("event_id div 3").cast("string")), *full[1:]))
            .when(m == 4, obj(*full[:3], ("payload", F.lit("null"))))
            .when(m == 5, obj(*full[:3], ("payload", F.lit("[1]"))))
            .when(m == 6, obj(full[0], full[1], ("timestamp", q(F.lit(BAD_TIMESTAMP_TEXT))), full[3]))
            .when(m == 7, obj(*full[:3]))
            .when(m == 8, obj(full[0], ("user_id", F.lit('""')), full[2], full[3]))
            .when(m == 9, obj(*full, ("x", F.lit("1"))))
            .when(m == 10, obj(*full, ("user_name", q(F.lit(PRESET_USER_NAME)))))
            .when(m == 11, obj(full[0], full[1], ("timestamp", q(F.lit(TIME_ONLY_TEXT))), full[3]))
            .when(m == 12, obj(full[0], full[1], ("timestamp", q(F.lit(YEAR_ONLY_TEXT))), full[3]))
            .when(m == 13, obj(full[0], full[1], ("timestamp", q(F.date_format(
                F.col("ts") + F.expr("INTERVAL 2 HOURS"), ISO_PLUS_TWO))), full[3]))
            .otherwise(obj(*full)))
    return events.select(eid.alias("seq"), text.alias("text"), u.alias("user_key"),
                         F.col("ts").alias("event_ts"))


def messages_from_events(events: DataFrame, topic: str = "events") -> DataFrame:
    """Kafka-shaped messages derived from ``events``, spread over partitions; offset = event_id."""
    msg = message_text(events.select("event_id", "user_id", "ts", "props"))
    return msg.select(
        F.col("user_key").cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("seq") % PARTITIONS).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.col("event_ts").cast("timestamp").alias("timestamp"))


def bounded_batch(decoded: DataFrame, limit: int, order: tuple[str, ...] = ("partition", "offset"),
                  decoded_col: str = "v") -> DataFrame:
    """At most ``limit`` successfully decoded messages, earliest first.

    Planned as a top-k (``TakeOrderedAndProject``): each task keeps only its
    first ``limit`` rows; the rows kept meet in one task, which holds ``limit`` of them.
    """
    return decoded.where(F.col(decoded_col).isNotNull()).orderBy(*order).limit(limit)


# Messages of one block of offsets, the grain in which a bounded read looks for its end.
BLOCK_OFFSETS = 10_000


def bounded_messages(messages: DataFrame, limit: int, block: int = BLOCK_OFFSETS) -> DataFrame:
    """The messages from the start up to the ``limit``-th that can be decoded, in order of (partition, offset).

    Blocks of offsets are counted without their values; blocks are then decoded in order until they hold ``limit``
    good messages, twice as many each time, and the place of the last one is looked up in its block. The result is a comparison on
    partition and offset: nothing behind it is decoded, and as many tasks read it as the source has.
    """
    ok = decode_json(F.col("value"), messages.schema["value"].dataType).isNotNull()
    number = F.floor(F.col("offset") / block).cast("long").alias("block")
    blocks = sorted((r["partition"], r["block"], r["count"]) for r in
                    messages.select("partition", number).groupBy("partition", "block").count().collect())  # one row per block
    p, o = F.col("partition"), F.col("offset")
    found = at = step = 0
    while at < len(blocks):
        need, stop, held = max(limit - found, 2 * step), at, 0
        while stop < len(blocks) and held < need:
            held += blocks[stop][2]
            stop += 1
        step = held
        (p0, b0, _), (p1, b1, _) = blocks[at], blocks[stop - 1]
        some = messages.where(((p > p0) | ((p == p0) & (o >= b0 * block))) & ((p < p1) | ((p == p1) & (o < (b1 + 1) * block))))
        good = {(r["partition"], r["block"]): r["n"] for r in
                some.select("partition", number, ok.alias("ok")).groupBy("partition", "block").agg(F.count_if("ok").alias("n")).collect()}
        for part, b, _ in blocks[at:stop]:
            n = good.get((part, b), 0)
            if found + n >= limit:
                inside = messages.where((p == part) & (o >= b * block) & (o < (b + 1) * block)).where(ok)
                last = inside.select("offset").orderBy("offset").limit(limit - found).agg(F.max("offset")).first()[0]  # within a block
                return messages.where((p < part) | ((p == part) & (o <= last)))
            found += n
        at = stop
    return messages
