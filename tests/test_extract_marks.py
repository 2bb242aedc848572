"""Extract forms, marks, control table and commit gate."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions.marks import Mark
from tidewater.operators.marks import commit_gate
from tidewater.sinks.control import append_control, read_control
from tidewater.sources.tables import chunk_stats, extract, jdbc_options


def _df(spark):
    rows = [(1, dt.datetime(2024, 3, 10, 11)), (2, dt.datetime(2024, 3, 10, 12)),
            (3, dt.datetime(2024, 3, 10, 13)), (4, None)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz")


def test_full_load_ignores_mark_without_column(spark):
    assert extract(_df(spark), None, Mark("2024-03-10T12:00:00", "timestamp_ntz")).count() == 4


def test_initial_load_keeps_null_marks(spark):
    assert extract(_df(spark), "ts", None).count() == 4


def test_incremental_is_strict_and_skips_null(spark):
    got = [r.id for r in extract(_df(spark), "ts", Mark("2024-03-10T12:00:00", "timestamp_ntz")).collect()]
    assert got == [3]


def test_incremental_predicate_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = extract(df, "o_orderdate", Mark("1998-01-01T00:00:00", "timestamp_ntz"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan


def test_numeric_mark_from_python(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "k long")
    assert extract(df, "k", 12345).count() == 0
    assert extract(df, "k", 15).count() == 4


def test_chunk_stats(spark):
    df = spark.createDataFrame([(i,) for i in range(25)], "k long")
    got = sorted(tuple(r) for r in chunk_stats(df, "k", 10).collect())
    assert got == [(0, 10, 0, 9), (1, 10, 10, 19), (2, 5, 20, 24)]
    assert chunk_stats(df, "k", None).count() == 1


def test_jdbc_options():
    o = jdbc_options("jdbc:x", partition_column="id", lower_bound=0, upper_bound=100,
                     num_partitions=4, fetchsize=10000, dbtable="t")
    assert o["numPartitions"] == "4" and o["fetchsize"] == "10000" and o["dbtable"] == "t"


def test_control_table_missing_empty_and_latest(spark, scratch):
    assert read_control(spark, f"{scratch}/none").count() == 0
    rows = spark.createDataFrame([("table1", "2024-01-01T10:00:00", "timestamp_ntz"),
                                  ("table2", "12345", "bigint")],
                                 "table_name string, hwm_value string, hwm_type string")
    append_control(rows, scratch, "r1")
    append_control(rows.where("table_name = 'table2'").withColumn("hwm_value", F.lit("12346")), scratch, "r2")
    got = {r.table_name: (r.hwm_value, r.hwm_type) for r in read_control(spark, scratch).collect()}
    assert got == {"table1": ("2024-01-01T10:00:00", "timestamp_ntz"), "table2": ("12346", "bigint")}


def test_control_table_corrupt_reads_empty(spark, scratch):
    spark.createDataFrame([("{invalid json format",)], "value string").write.text(f"{scratch}/v=00000001.x")
    assert read_control(spark, scratch).count() == 0


def test_commit_gate_cases(spark):
    # (table, incremental column, old, new (folded), rows, failed) -> expected mark
    cases = [("a", "c", None, "10", 5, 0, "10"), ("b", "c", "10", "20", 5, 0, "20"),
             ("c", "c", "10", "10", 5, 0, "10"), ("d", "c", "10", "20", 5, 1, "10"),
             ("e", "c", "10", None, 0, 0, "10"), ("f", None, None, None, 5, 0, None),
             ("g", "c", None, None, 5, 0, None)]
    df = spark.createDataFrame([c[:6] for c in cases],
                               "table_name string, incremental_column string, old_mark string, "
                               "new_mark string, rows long, failed long")
    got = {r.table_name: r.mark for r in commit_gate(df).collect()}
    assert got == {c[0]: c[6] for c in cases}


def test_jdbc_range_options_from_chunk_size():
    from tidewater.sources.tables import jdbc_range_options
    o = jdbc_range_options("jdbc:x", "id", 1, 25000, 10000, dbtable="t")
    assert (o["partitionColumn"], o["numPartitions"], o["lowerBound"], o["upperBound"]) == ("id", "3", "1", "25001")
    assert "partitionColumn" not in jdbc_range_options("jdbc:x", "id", 1, 25000, None, dbtable="t")


def test_control_table_empty_folder_and_nested_save(spark, scratch):
    import os
    empty = f"{scratch}/empty"
    os.makedirs(empty.replace("file:", ""), exist_ok=True)
    assert read_control(spark, empty).count() == 0
    nested = f"{scratch}/a/b/c/state"
    rows = spark.createDataFrame([("t", "5", "bigint")], "table_name string, hwm_value string, hwm_type string")
    append_control(rows, nested, "r1")
    assert [tuple(r) for r in read_control(spark, nested).collect()] == [("t", "5", "bigint")]


def test_mark_round_trip_types(spark):
    from pyspark.sql.types import DateType, DoubleType, LongType, TimestampNTZType
    from tidewater.functions.marks import encode_mark
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 6), dt.date(2024, 1, 2), 7, 2.5)],
                               "a timestamp_ntz, b date, c long, d double")
    for col, t in (("a", TimestampNTZType()), ("b", DateType()), ("c", LongType()), ("d", DoubleType())):
        text = df.select(encode_mark(F.col(col), t)).first()[0]
        back = df.select(Mark(text, t.simpleString()).literal().alias("x")).first()[0]
        assert back == df.first()[col]


def test_connection_options_from_settings_sections():
    from tidewater.sources.tables import connection_options
    o = connection_options({"user": "u", "password": "p", "dsn": "h:1521/svc"}, "oracle", dbtable="emp")
    assert o["url"] == "jdbc:oracle:thin:@//h:1521/svc" and o["user"] == "u" and o["dbtable"] == "emp"
    m = connection_options({"user": "u", "password": "p", "host": "db", "database": "tgt"}, "mysql")
    assert m["url"] == "jdbc:mysql://db:3306/tgt" and m["driver"] == "com.mysql.cj.jdbc.Driver"
