"""Event ingest chain: decode, validate, dedup, enrich, load, stream."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidewater.operators.enrich import enrich_left, load_lookup
from tidewater.operators.validate import validate_messages
from tidewater.plans.ingest import decode_messages, dedup_valid, ingest_batch
from tidewater.sinks.events import append_daily
from tidewater.sources.messages import bounded_batch, kafka_options
from tidewater.streaming.ingest_stream import MESSAGE_SCHEMA, ingest_stream, read_message_stream

GOOD = {"event_id": "e1", "user_id": "user123", "timestamp": "2024-03-10T12:00:00Z", "payload": {"a": 1}}


def _msgs(spark, values):
    rows = [(None, v if isinstance(v, (bytes, type(None))) else v.encode("utf-8"), "t", 0, i, None)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def _lookup(spark):
    return spark.createDataFrame([("user123", "Alice", "NY"), ("user456", "Bob", None)],
                                 "user_id string, user_name string, user_location string")


def test_decode_skips_bad_bytes_json_and_null(spark):
    d = decode_messages(_msgs(spark, [json.dumps(GOOD), b"\xff\xfe", "{bad", None, '{"a":1,"a":2}']))
    got = [r.v is not None for r in d.orderBy("offset").collect()]
    assert got == [True, False, False, False, True]
    dup = d.where("offset = 4").select(F.variant_get("v", "$.a", "int")).first()[0]
    assert dup == 2  # repeated key: last value wins


def test_validation_reasons(spark):
    cases = [(GOOD, None), ([1, 2], "not_object"), ({**GOOD, "event_id": 5}, "bad_event_id"),
             ({k: v for k, v in GOOD.items() if k != "user_id"}, "bad_user_id"),
             ({**GOOD, "timestamp": 1}, "bad_timestamp_type"), ({**GOOD, "payload": None}, "bad_payload"),
             ({**GOOD, "payload": "x"}, "bad_payload"),
             ({k: v for k, v in GOOD.items() if k != "payload"}, None), ({**GOOD, "extra": 1}, None)]
    d = decode_messages(_msgs(spark, [json.dumps(c) for c, _ in cases]))
    got = [r.reason for r in validate_messages(d).orderBy("offset").collect()]
    assert got == [r for _, r in cases]


def test_dedup_keeps_first_in_arrival_order(spark):
    vals = [json.dumps({**GOOD, "payload": {"n": i}}) for i in range(3)]
    u = dedup_valid(validate_messages(decode_messages(_msgs(spark, vals))))
    assert [(r.offset, r.payload) for r in u.collect()] == [(0, '{"n":0}')]


def test_enrichment_rules(spark):
    vals = [GOOD, {**GOOD, "event_id": "e2", "user_id": "user456", "user_name": "preset", "user_location": "x"},
            {**GOOD, "event_id": "e3", "user_id": "nobody", "user_name": "preset"},
            {**GOOD, "event_id": "e4", "user_id": ""}]
    u = dedup_valid(validate_messages(decode_messages(_msgs(spark, [json.dumps(v) for v in vals]))))
    e = {r.event_id: (r.user_name, r.user_location, r.matched)
         for r in enrich_left(u, _lookup(spark)).collect()}
    assert e == {"e1": ("Alice", "NY", True), "e2": ("Bob", None, True),
                 "e3": ("preset", None, False), "e4": (None, None, False)}
    assert enrich_left(u, _lookup(spark), max_broadcast_rows=0).count() == u.count()


def test_lookup_down_degrades(spark):
    dim, ok = load_lookup(spark, lambda: spark.read.parquet("/nonexistent/profiles"), "user_id",
                          ["user_name", "user_location"])
    assert not ok and dim.count() == 0


def test_bounded_batch_counts_decoded_only(spark):
    d = decode_messages(_msgs(spark, ["{bad", json.dumps(GOOD), "{bad", json.dumps(GOOD), json.dumps(GOOD)]))
    assert [r.offset for r in bounded_batch(d, 2).collect()] == [1, 3]


def test_batch_laws_on_tables(spark):
    from tidewater.catalog.queries import _lookup as lookup, _messages as messages
    sf = "/root/testdata/sf0.001"
    r = ingest_batch(messages(spark, sf), lookup(spark, sf))
    dec = r.decoded.where("v is not null").count()
    assert r.validated.count() == dec
    valid = r.validated.where("reason is null")
    assert r.unique.count() == valid.select("event_id").distinct().count()
    assert r.enriched.count() == r.unique.count()
    assert r.rows.count() + r.quarantine.count() == r.unique.count()


def test_append_daily_is_idempotent_per_batch(spark, scratch):
    from tidewater.catalog.queries import _lookup as lookup, _messages as messages
    sf = "/root/testdata/sf0.001"
    rows = ingest_batch(messages(spark, sf), lookup(spark, sf)).rows
    append_daily(rows, scratch, batch_id=7)
    append_daily(rows, scratch, batch_id=7)
    assert spark.read.parquet(scratch).count() == rows.count()


def test_required_columns_enforced(spark, scratch):
    import pytest
    bad = spark.createDataFrame([(None, "u", dt.datetime(2024, 1, 1), None, None, None)],
                                "event_id string, user_id string, timestamp timestamp, payload string, "
                                "user_name string, user_location string").withColumn("event_date", F.to_date("timestamp"))
    with pytest.raises(Exception):
        append_daily(bad, scratch)


def test_stream_equals_batch(spark, scratch):
    from tidewater.catalog.queries import _lookup as lookup, _messages as messages
    sf = "/root/testdata/sf0.001"
    messages(spark, sf).write.parquet(f"{scratch}/src")
    ingest_stream(read_message_stream(spark, "parquet", f"{scratch}/src"), lookup(spark, sf),
                  f"{scratch}/sink", f"{scratch}/ckpt")
    streamed = spark.read.parquet(f"{scratch}/sink").drop("ingest_batch")
    from tidewater.sinks.events import SINK_COLUMNS
    batch = ingest_batch(messages(spark, sf), lookup(spark, sf)).rows.select(*SINK_COLUMNS, "event_date")
    key = lambda df: sorted(tuple(r) for r in df.select(*sorted(batch.columns)).collect())
    assert key(streamed) == key(batch)


def test_kafka_options():
    o = kafka_options("b1:9092,b2:9092", "topic", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "topic" and o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "1000"


def test_bad_timestamp_quarantined_or_strict(spark):
    import pytest
    from tidewater.spec import IngestSpec
    vals = [json.dumps(GOOD), json.dumps({**GOOD, "event_id": "e2", "timestamp": "not a time"})]
    r = ingest_batch(_msgs(spark, vals), _lookup(spark))
    assert [x.event_id for x in r.rows.collect()] == ["e1"]
    assert [(x.event_id, x.reason_load) for x in r.quarantine.collect()] == [("e2", "bad_timestamp")]
    strict = ingest_batch(_msgs(spark, vals), _lookup(spark), IngestSpec(strict_load=True))
    with pytest.raises(Exception):
        strict.rows.collect()


def test_clustered_append(spark, scratch):
    from tidewater.catalog.queries import _lookup as lookup, _messages as messages
    sf = "/root/testdata/sf0.001"
    rows = ingest_batch(messages(spark, sf), lookup(spark, sf)).rows
    append_daily(rows, scratch, cluster_by=("user_id",))
    assert spark.read.parquet(scratch).count() == rows.count()


def test_cross_batch_dedup_stream(spark, scratch):
    from tidewater.streaming.ingest_stream import cross_batch_dedup
    vals = [json.dumps({**GOOD, "payload": {"n": i}}) for i in range(4)]
    base = _msgs(spark, vals).withColumn("timestamp", F.current_timestamp())
    base.write.parquet(f"{scratch}/src")
    stream = read_message_stream(spark, "parquet", f"{scratch}/src")
    deduped = cross_batch_dedup(stream, F.get_json_object(F.col("value").cast("string"), "$.event_id"))
    q = (deduped.writeStream.format("memory").queryName("xdedup").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select count(*) from xdedup").first()[0] == 1


def test_stream_resumes_from_checkpoint(spark, scratch):
    from tidewater.catalog.queries import _lookup as lookup, _messages as messages
    sf = "/root/testdata/sf0.001"
    msgs = messages(spark, sf)
    msgs.where("offset % 2 = 0").write.parquet(f"{scratch}/src/part=a")
    src = read_message_stream(spark, "parquet", f"{scratch}/src")
    ingest_stream(src, lookup(spark, sf), f"{scratch}/sink", f"{scratch}/ckpt")
    first = spark.read.parquet(f"{scratch}/sink").count()
    msgs.where("offset % 2 = 1").write.parquet(f"{scratch}/src/part=b")
    ingest_stream(read_message_stream(spark, "parquet", f"{scratch}/src"), lookup(spark, sf),
                  f"{scratch}/sink", f"{scratch}/ckpt")
    sink = spark.read.parquet(f"{scratch}/sink")
    assert sink.count() > first
    assert sink.select("ingest_batch").distinct().count() == 2


def test_append_daily_reports_rows(spark, scratch):
    from tidewater.catalog.queries import _lookup as lookup, _messages as messages
    sf = "/root/testdata/sf0.001"
    rows = ingest_batch(messages(spark, sf), lookup(spark, sf)).rows
    assert append_daily(rows, scratch) == rows.count()


def test_stream_cross_batch_dedup_option(spark, scratch):
    from tidewater.spec import IngestSpec
    vals = [json.dumps({**GOOD, "payload": {"n": i}}) for i in range(3)]
    base = _msgs(spark, vals).withColumn("timestamp", F.current_timestamp())
    base.where("offset = 0").write.parquet(f"{scratch}/src/part=a")
    run = lambda: ingest_stream(read_message_stream(spark, "parquet", f"{scratch}/src"), _lookup(spark),
                                f"{scratch}/sink", f"{scratch}/ckpt", IngestSpec(cross_batch_delay="1 hour"))
    run()
    base.where("offset > 0").write.parquet(f"{scratch}/src/part=b")
    run()
    assert spark.read.parquet(f"{scratch}/sink").count() == 1


def test_root_kind_reads_past_any_leading_blanks(spark):
    vals = [" " * 200 + json.dumps(GOOD), "\n\t[1]", ' "s"', "12", " null"]
    got = [r.kind for r in decode_messages(_msgs(spark, vals)).orderBy("offset").collect()]
    assert got == ["object", "array", "string", "number", "null"]


def test_two_streams_into_one_sink_do_not_collide(spark, scratch):
    from tidewater.catalog.queries import _lookup as lookup, _messages as messages
    sf = "/root/testdata/sf0.001"
    msgs = messages(spark, sf)
    msgs.where("offset % 2 = 0").write.parquet(f"{scratch}/s1/part=a")
    msgs.where("offset % 2 = 1").write.parquet(f"{scratch}/s2/part=a")
    for src, ck in (("s1", "ck1"), ("s2", "ck2")):
        ingest_stream(read_message_stream(spark, "parquet", f"{scratch}/{src}"), lookup(spark, sf),
                      f"{scratch}/sink", f"{scratch}/{ck}")
    sink = spark.read.parquet(f"{scratch}/sink")
    assert sink.select("ingest_batch").distinct().count() == 2


def test_event_date_is_the_utc_day_in_any_session_zone(spark):
    vals = [json.dumps({**GOOD, "timestamp": "2024-03-10T02:00:00Z"}),
            json.dumps({**GOOD, "event_id": "e2", "timestamp": "2024-03-10T23:30:00-05:00"})]
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r.event_id: str(r.event_date) for r in ingest_batch(_msgs(spark, vals), _lookup(spark)).rows.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == {"e1": "2024-03-10", "e2": "2024-03-11"}


def test_rejected_messages_are_kept_with_their_reason(spark):
    vals = [json.dumps(GOOD), json.dumps([1]), json.dumps({**GOOD, "user_id": 7})]
    r = ingest_batch(_msgs(spark, vals), _lookup(spark))
    assert sorted(x.reason for x in r.rejected.collect()) == ["bad_user_id", "not_object"]
    assert r.rows.count() == 1


def test_a_stream_refuses_to_cut_its_batches(spark, scratch):
    import pytest
    from tidewater.spec import IngestSpec
    _msgs(spark, [json.dumps(GOOD)]).write.parquet(f"{scratch}/src")
    with pytest.raises(ValueError):
        ingest_stream(read_message_stream(spark, "parquet", f"{scratch}/src"), _lookup(spark), f"{scratch}/sink",
                      f"{scratch}/ckpt", IngestSpec(max_messages=4))


def test_invalid_copy_does_not_remove_a_later_valid_one(spark, scratch):
    from tidewater.spec import IngestSpec
    vals = [json.dumps({**GOOD, "user_id": 7}), json.dumps({**GOOD, "event_id": 1}), json.dumps(GOOD),
            json.dumps({**GOOD, "payload": {"again": 1}}), "{bad"]
    base = _msgs(spark, vals).withColumn("timestamp", F.current_timestamp())
    for n in range(len(vals)):
        base.where(f"offset = {n}").write.parquet(f"{scratch}/src/part={n}")
        ingest_stream(read_message_stream(spark, "parquet", f"{scratch}/src"), _lookup(spark), f"{scratch}/sink",
                      f"{scratch}/ckpt", IngestSpec(cross_batch_delay="1 hour"), rejects_path=f"{scratch}/rejects",
                      summary_path=f"{scratch}/summary")
    sink = spark.read.parquet(f"{scratch}/sink").collect()
    assert [json.loads(r.payload) for r in sink] == [GOOD["payload"]]
    assert sorted(r.reason for r in spark.read.parquet(f"{scratch}/rejects").collect()) == ["bad_event_id", "bad_user_id"]
    total = spark.read.parquet(f"{scratch}/summary").agg(F.sum("messages"), F.sum("skipped"), F.sum("invalid"),
                                                         F.sum("duplicates"), F.sum("loaded")).first()
    assert tuple(total) == (5, 1, 2, 1, 1)


def test_ingest_goes_on_without_a_lookup_that_fails_while_it_is_read(spark, scratch):
    from tidewater.plans.ingest import load_batch, prepare_for_run
    from tidewater.spec import IngestSpec
    broken = lambda: _lookup(spark).withColumn("user_name", F.raise_error(F.lit("down")).cast("string"))
    lookup = prepare_for_run(spark, broken, IngestSpec())
    assert not lookup.available
    counts = load_batch(_msgs(spark, [json.dumps(GOOD)]), lookup, f"{scratch}/sink")
    assert (counts["missed"], counts["loaded"], counts["lookup_available"]) == (1, 1, False)


def test_only_full_date_times_are_loaded(spark):
    texts = ["12:30:00", "2024", "2024-03-10", "2024-03", "not a time", "2024-03-10T12:00:00Z", "2024-03-10 12:00",
             "2024-03-10T12:00:00.5+02:00", "2024-13-10T12:00:00Z"]
    vals = [json.dumps({**GOOD, "event_id": f"e{i}", "timestamp": t}) for i, t in enumerate(texts)]
    rows = ingest_batch(_msgs(spark, vals), _lookup(spark)).rows.collect()
    assert sorted(r.event_id for r in rows) == ["e5", "e6", "e7"]
