"""Equi-depth read ranges and the bounded read of a topic."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions.json import decode_json
from tidewater.sources import tables
from tidewater.sources.messages import bounded_batch, bounded_messages
from tidewater.sources.ranges import equi_depth_borders, range_predicates, range_stats, sql_literal
from tidewater.plans.ingest import decode_messages
from tidewater.streaming.ingest_stream import MESSAGE_SCHEMA


def _keys(spark):
    """Keys that are dense at one end and sparse at the other, of several types."""
    x = F.pow(F.col("id") / 100, 4).cast("long")
    return spark.range(5000).select(x.alias("n"), F.concat(F.lit("it's "), F.lpad(x.cast("string"), 12, "0")).alias("s"),
                                    (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=x.cast("double"))).alias("t"),
                                    F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 7).cast("int")).alias("d"),
                                    (F.col("id") / 3).cast("decimal(12,3)").alias("c"))


@pytest.mark.parametrize("key", ["n", "s", "t", "d", "c"])
def test_ranges_are_even_and_hold_every_row_once(spark, key):
    df = _keys(spark).withColumn(key, F.when(F.rand(3) > 0.02, F.col(key)))
    borders = equi_depth_borders(df, key, 500)
    conditions = range_predicates(key, borders)
    counts = df.agg(*[F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(conditions)]).first()
    assert len(conditions) >= 8 and sum(counts) == 5000 and max(counts) <= 1000
    assert sorted(r["rows"] for r in range_stats(df, key, 500, borders).collect()) == sorted(c for c in counts if c)


def test_one_value_with_a_third_of_the_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("k"))
    rows = {r["min_key"]: r["rows"] for r in range_stats(df, "k", 300).collect()}
    assert sum(rows.values()) == 3000 and sorted(rows.values())[-2] <= 600
    assert equi_depth_borders(df.limit(0), "k", 300) == [] == equi_depth_borders(df, "k", 10_000)
    assert range_predicates("k", []) == ["1 = 1"]


def test_literals():
    assert sql_literal("o'clock") == "'o''clock'" and sql_literal(3) == "3"
    assert sql_literal(dt.datetime(2024, 1, 2, 3, 4, 5, 6)) == "TIMESTAMP '2024-01-02 03:04:05.000006'"
    assert sql_literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'"


def test_jdbc_reads_cut_text_keys_by_conditions(spark, monkeypatch):
    """No database here: the reader is a stand-in that takes the same calls."""
    rows, asked = _keys(spark), {}

    class Reader:
        def format(self, _):
            return self

        def options(self, **opts):
            asked["options"] = opts
            return self

        def load(self):
            return rows

        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)
            return rows

    class Session:
        read = Reader()
    monkeypatch.setattr(tables, "jdbc_bounds", lambda *a: ("a", "z"))
    base = {"url": "jdbc:mysql://db/x", "dbtable": "emp", "user": "u"}
    tables.read_jdbc_chunks(Session(), base, "s", 1000)
    assert (asked["url"], asked["table"], asked["properties"]) == ("jdbc:mysql://db/x", "emp", {"user": "u"})
    assert 4 <= len(asked["predicates"]) <= 5 and asked["predicates"][-1].startswith("s >= 'it''s ")
    monkeypatch.setattr(tables, "jdbc_bounds", lambda *a: (1, 95_000))
    tables.read_jdbc_chunks(Session(), base, "n", 10_000)
    assert asked["options"]["numPartitions"] == "10"


def _messages(spark, good):
    rows = [(None, b"{}" if ok else b"{bad", "t", p, o, None) for p, offsets in good.items() for o, ok in offsets]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


@pytest.mark.parametrize("limit", [1, 7, 40, 55, 56, 1000])
@pytest.mark.parametrize("block", [3, 10_000])
def test_bounded_messages_end_at_the_last_one_decoded(spark, limit, block):
    good = {0: [(i, i % 4 != 0) for i in range(5, 45)], 2: [(i * 7, i > 30) for i in range(50)], 5: [(3, False), (9, True)]}
    msgs = _messages(spark, good).repartition(5)
    flat = [(p, o, ok) for p in sorted(good) for o, ok in sorted(good[p])]
    places = [i for i, (_, _, ok) in enumerate(flat) if ok]
    want = flat[:places[limit - 1] + 1] if limit <= len(places) else flat
    kept = bounded_messages(msgs, limit, block)
    assert sorted((r["partition"], r["offset"]) for r in kept.collect()) == [(p, o) for p, o, _ in want]
    decoded = decode_messages(kept).where("v is not null")
    same = bounded_batch(decode_messages(msgs), limit)
    assert {(r.partition, r.offset) for r in decoded.select("partition", "offset").collect()} == \
        {(r.partition, r.offset) for r in same.select("partition", "offset").collect()}


def test_bounded_read_does_not_decode_what_lies_behind(spark, scratch):
    good = {p: [(i, True) for i in range(1000)] for p in range(3)}
    _messages(spark, good).repartitionByRange(6, "partition", "offset").sortWithinPartitions("partition", "offset") \
        .write.parquet(scratch)
    msgs = spark.read.parquet(scratch)
    kept = bounded_messages(msgs, 200, block=100)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(LessThan(partition," in plan and kept.count() == 200
    spent = kept.select(F.count_if(decode_json(F.col("value"), msgs.schema["value"].dataType).isNotNull())).first()[0]
    assert spent == 200


def test_bounded_messages_of_nothing(spark):
    assert bounded_messages(spark.createDataFrame([], MESSAGE_SCHEMA), 5).count() == 0
