"""Upsert, last-wins, insert-only, affected rows, versioned publish, migration."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators.dedup import keep_first, keep_last
from tidewater.sources.tables import extract
from tidewater.operators.upsert import affected_rows, insert_only, upsert
from tidewater.plans.migration import migrate_all
from tidewater.sinks.control import read_control
from tidewater.sinks.versioned import current_version, publish, read_current
from tidewater.spec import MigrationSpec, TableSpec

SCHEMA = "id long, name string, value long"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_upsert_inserts_and_overwrites(spark, strategy):
    tgt = spark.createDataFrame([(1, "Old", 1, "t1"), (3, "Keep", 3, "t3")], SCHEMA + ", note string")
    src = spark.createDataFrame([(1, "Alice", None), (2, "Bob", 20)], SCHEMA)
    out = upsert(tgt, src, strategy=strategy)
    assert out.columns == ["id", "name", "value", "note"]
    assert _rows(out) == [(1, "Alice", None, "t1"), (2, "Bob", 20, None), (3, "Keep", 3, "t3")]


def test_upsert_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    src = spark.createDataFrame([(1, "b", 2), (2, "c", 3)], SCHEMA)
    once = upsert(tgt, src)
    assert _rows(upsert(once, src)) == _rows(once)


def test_upsert_last_wins_with_order(spark):
    tgt = spark.createDataFrame([], SCHEMA + ", ver long")
    src = spark.createDataFrame([(1, "v1", 1, 1), (1, "v3", 3, 3), (1, "v2", 2, 2)], SCHEMA + ", ver long")
    assert _rows(upsert(tgt, src, ["id"], order_by=["ver"])) == [(1, "v3", 3, 3)]


def test_upsert_rejects_unknown_source_column(spark):
    tgt = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    src = spark.createDataFrame([(1, 2)], "id long, other long")
    with pytest.raises(ValueError):
        upsert(tgt, src)


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "k string, seq long, v string")
    assert _rows(keep_first(df, ["k"], ["seq"])) == [("a", 1, "x"), ("b", 3, "z")]
    assert _rows(keep_last(df, ["k"], ["seq"])) == [("a", 2, "y"), ("b", 3, "z")]


def test_insert_only_conflicts(spark):
    tgt = spark.createDataFrame([(101,)], "pk_col long")
    new, conflicts = insert_only(tgt, spark.createDataFrame([(101,), (102,), (103,), (103,)], "pk_col long"))
    assert _rows(new) == [(102,), (103,), (103,)]
    assert _rows(conflicts) == [(101,), (103,)]


@pytest.mark.parametrize("skew_safe", [True, False])
def test_affected_rows_accounting(spark, skew_safe):
    tgt = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    src = spark.createDataFrame([(1, "a", 1, 1), (2, "B", 2, 1), (3, "c", 3, 1), (3, "c", 3, 2), (3, "C", 3, 3)],
                                SCHEMA + ", ver long")
    got = {(r.id, r.ver): r.affected for r in affected_rows(tgt, src, ["id"], ["ver"], skew_safe=skew_safe).collect()}
    # same -> 0, changed -> 2, new -> 1, repeated identical -> 0, changed again -> 2
    assert got == {(1, 1): 0, (2, 1): 2, (3, 1): 1, (3, 2): 0, (3, 3): 2}


def test_publish_versions(spark, scratch):
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    assert read_current(spark, scratch) is None
    p1 = publish(df, scratch)
    p2 = publish(df.union(df), scratch)
    assert current_version(spark, scratch) == p2 != p1
    assert read_current(spark, scratch).count() == 2


def _events(spark, n=40):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(hours=i), i % 4, float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")


@pytest.mark.parametrize("freeze", [True, False])
def test_two_incremental_runs_equal_one_full_run(spark, scratch, freeze):
    ev = _events(spark)
    ev.where("event_id < 25").write.parquet(f"{scratch}/snap")
    ev.write.parquet(f"{scratch}/full")

    def spec(path, root):
        t = TableSpec(source="ev", target="ev_t", incremental_column="ts", keys=["user_id"],
                      source_options={"path": path}, freeze=freeze)
        return MigrationSpec([t], source_root=scratch, target_root=f"{scratch}/{root}",
                             state_path=f"{scratch}/{root}_ctl")

    r1 = migrate_all(spark, spec(f"{scratch}/snap", "a")).first()
    r2 = migrate_all(spark, spec(f"{scratch}/full", "a")).first()
    assert (r1.rows, r2.rows) == (25, 15) and r1.advanced and r2.advanced
    assert r2.old_mark == "2024-01-02T00:00:00.000000"
    migrate_all(spark, spec(f"{scratch}/full", "b"))
    two = read_current(spark, f"{scratch}/a/ev_t")
    one = read_current(spark, f"{scratch}/b/ev_t")
    assert _rows(two) == _rows(one) and two.count() == 4
    # nothing new: no rows, mark kept
    r3 = migrate_all(spark, spec(f"{scratch}/full", "a")).first()
    assert r3.rows == 0 and not r3.advanced and r3.mark == r2.mark


@pytest.mark.parametrize("freeze", [True, False])
def test_failed_table_is_isolated(spark, scratch, freeze):
    ev = _events(spark)
    ev.write.parquet(f"{scratch}/full")
    tables = [TableSpec(source="missing", target="m_t", incremental_column="ts",
                        source_options={"path": f"{scratch}/nope"}),
              TableSpec(source="nulls", target="n_t", incremental_column="ts",
                        source_options={"path": f"{scratch}/full"}, freeze=freeze,
                        transforms=(lambda d: d.withColumn("event_id", F.lit(None).cast("long")),)),
              TableSpec(source="ev", target="ev_t", incremental_column="ts",
                        source_options={"path": f"{scratch}/full"})]
    spec = MigrationSpec(tables, source_root=scratch, target_root=f"{scratch}/t", state_path=f"{scratch}/c")
    got = {r.table_name: (r.status, r.failed, r.advanced) for r in migrate_all(spark, spec).collect()}
    assert got == {"missing": ("failed", 0, False), "nulls": ("failed", 40, False), "ev": ("ok", 0, True)}
    assert {r.table_name for r in read_control(spark, f"{scratch}/c").collect()} == {"ev"}
    assert read_current(spark, f"{scratch}/t/n_t") is None


def test_affected_rows_hot_key_across_ranges(spark):
    """One key holding most versions is split over ranges; result equals a sequential scan."""
    import random
    rnd = random.Random(7)
    rows, expected = [], {}
    tgt_rows = [(0, "t", 0), (5, "x", 5)]
    tval = {0: ("t", 0), 5: ("x", 5)}
    for key, n in ((0, 400), (1, 3), (5, 2), (9, 50)):
        prev = tval.get(key)
        for ver in range(n):
            val = (rnd.choice("ab"), rnd.choice([0, 1]))
            kind = 1 if prev is None else (2 if val != prev else 0)
            expected[(key, ver)] = kind
            rows.append((key, val[0], val[1], ver))
            prev = val
    tgt = spark.createDataFrame(tgt_rows, SCHEMA)
    src = spark.createDataFrame(rows, SCHEMA + ", ver long")
    got = {(r.id, r.ver): r.affected for r in affected_rows(tgt, src, ["id"], ["ver"], partitions=16).collect()}
    assert got == expected


def test_bucketed_target_rewrites_only_touched_buckets(spark, scratch):
    from tidewater.sinks.bucketed import read_bucketed, upsert_bucketed
    base = spark.createDataFrame([(i, f"n{i}", i) for i in range(200)], SCHEMA)
    root = f"{scratch}/b"
    assert len(upsert_bucketed(base, root, ["id"], 16)) == 16
    change = spark.createDataFrame([(3, "changed", None), (500, "new", 5)], SCHEMA)
    touched = upsert_bucketed(change, root, ["id"], 16)
    assert len(touched) <= 2
    got = {r.id: (r.name, r.value) for r in read_bucketed(spark, root).collect()}
    assert len(got) == 201 and got[3] == ("changed", None) and got[500] == ("new", 5) and got[4] == ("n4", 4)


def test_bucketed_migration_equals_versioned(spark, scratch):
    ev = _events(spark)
    ev.where("event_id < 25").write.parquet(f"{scratch}/snap")
    ev.write.parquet(f"{scratch}/full")

    def spec(path, root, buckets):
        t = TableSpec(source="ev", target="ev_t", incremental_column="ts", keys=["user_id"],
                      source_options={"path": path}, buckets=buckets)
        return MigrationSpec([t], source_root=scratch, target_root=f"{scratch}/{root}",
                             state_path=f"{scratch}/{root}_ctl")

    from tidewater.sinks.bucketed import read_bucketed
    for path in (f"{scratch}/snap", f"{scratch}/full"):
        a = migrate_all(spark, spec(path, "v", None)).first()
        b = migrate_all(spark, spec(path, "k", 8)).first()
        assert (a.rows, a.affected, a.mark) == (b.rows, b.affected, b.mark)
    assert _rows(read_current(spark, f"{scratch}/v/ev_t")) == _rows(read_bucketed(spark, f"{scratch}/k/ev_t"))


def test_jdbc_merge_statements():
    from tidewater.sinks.jdbc import merge_statement
    assert merge_statement("t", "t_stg", ["id", "name", "value"], ["id"]) == (
        "INSERT INTO `t` (`id`, `name`, `value`) SELECT `id`, `name`, `value` FROM `t_stg` "
        "ON DUPLICATE KEY UPDATE `name` = VALUES(`name`), `value` = VALUES(`value`)")
    assert merge_statement("t", "t_stg", ["pk_col"], ["pk_col"]) == \
        "INSERT INTO `t` (`pk_col`) SELECT `pk_col` FROM `t_stg`"
    ansi = merge_statement("t", "s", ["id", "v"], ["id"], dialect="ansi")
    assert ansi.startswith('MERGE INTO "t" t USING "s" s ON (t."id" = s."id") WHEN MATCHED THEN UPDATE SET "v" = s."v"')


def test_insert_only_stats(spark):
    from tidewater.operators.upsert import insert_only_stats
    tgt = spark.createDataFrame([(101,)], "pk_col long")
    ok = insert_only_stats(tgt, spark.createDataFrame([(102,), (103,)], "pk_col long")).first()
    assert tuple(ok) == (2, 2, 0, 0, 2)
    bad = insert_only_stats(tgt, spark.createDataFrame([(101,), (102,), (103,), (103,)], "pk_col long")).first()
    assert tuple(bad) == (4, 3, 2, 4, 0)


def test_lookback_rereads_late_rows_without_moving_mark_back(spark, scratch):
    ev = _events(spark, 10)
    ev.write.parquet(f"{scratch}/src1")

    def spec(path, lookback):
        t = TableSpec(source="ev", target="ev_t", incremental_column="ts", source_options={"path": path},
                      lookback=lookback)
        return MigrationSpec([t], source_root=scratch, target_root=f"{scratch}/t", state_path=f"{scratch}/c")

    r1 = migrate_all(spark, spec(f"{scratch}/src1", "3 hours")).first()
    # a late row arrives with a timestamp below the mark
    late = spark.createDataFrame([(99, dt.datetime(2024, 1, 1, 8, 30), 1, 9.0)],
                                 "event_id long, ts timestamp_ntz, user_id long, value double")
    ev.unionByName(late).write.parquet(f"{scratch}/src2")
    r2 = migrate_all(spark, spec(f"{scratch}/src2", "3 hours")).first()
    assert r2.rows == 4 and r2.mark == r1.mark and not r2.advanced
    assert 99 in {r.event_id for r in read_current(spark, f"{scratch}/t/ev_t").collect()}
    plain = extract(spark.read.parquet(f"{scratch}/src2"), "ts", r1.mark).count()
    assert plain == 0


def test_publish_keeps_a_bounded_number_of_versions(spark, scratch):
    import os
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    for _ in range(5):
        publish(df, scratch, keep=2)
    local = scratch.replace("file:", "")
    assert len([n for n in os.listdir(local) if n.startswith("v=")]) == 2
    assert read_current(spark, scratch).count() == 1


def test_bucketed_upsert_with_shuffle_strategy(spark, scratch):
    from tidewater.sinks.bucketed import read_bucketed, upsert_bucketed
    base = spark.createDataFrame([(i, f"n{i}", i) for i in range(50)], SCHEMA)
    root = f"{scratch}/b"
    upsert_bucketed(base, root, ["id"], 4)
    change = spark.createDataFrame([(7, "x", 1), (60, "z", 3)], SCHEMA)
    upsert_bucketed(change, root, ["id"], 4)
    rows = read_bucketed(spark, root).collect()
    got = {r.id: r.name for r in rows}
    assert len(rows) == 51 and got[60] == "z" and got[7] == "x" and got[8] == "n8"


def test_command_line_migration(spark, scratch, capsys):
    from tidewater.__main__ import main
    import os
    local = scratch.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    ini = os.path.join(local, "db.ini")
    with open(ini, "w") as f:
        f.write("[migration]\nnation = nation_t\nnation.n_name = nation_t.name\n"
                "region = region_t\nchunk_size = 5000\n")
    code = main(["migrate", "--settings", ini, "--source-root", "/root/testdata/sf0.001",
                 "--target-root", f"{scratch}/t"])
    out = capsys.readouterr().out
    assert code == 0 and "nation\tok\trows=25" in out and "region\tok\trows=5" in out
    assert "name" in read_current(spark, f"{scratch}/t/nation_t").columns


def test_mark_advances_when_only_mapped_drops_the_incremental_column(spark, scratch):
    ev = _events(spark, 12)
    ev.write.parquet(f"{scratch}/src")
    t = TableSpec(source="ev", target="ev_t", incremental_column="ts", only_mapped=True,
                  columns={"event_id": "id", "value": "amount"}, source_options={"path": f"{scratch}/src"})
    spec = MigrationSpec([t], source_root=scratch, target_root=f"{scratch}/t", state_path=f"{scratch}/c")
    r = migrate_all(spark, spec).first()
    assert r.status == "ok" and r.rows == 12 and r.mark == "2024-01-01T11:00:00.000000"
    assert read_current(spark, f"{scratch}/t/ev_t").columns == ["id", "amount"]


@pytest.mark.parametrize("skew_safe", [True, False])
def test_first_load_counts_changes_between_versions(spark, skew_safe):
    src = spark.createDataFrame([(1, "a", 1, 1), (1, "a", 1, 2), (1, "b", 1, 3), (2, "x", 5, 1)],
                                SCHEMA + ", ver long")
    got = {(r.id, r.ver): r.affected for r in
           affected_rows(None, src, ["id"], ["ver", "name", "value"], skew_safe=skew_safe).collect()}
    # first version inserts; ver 2 differs from ver 1 only in ver itself, which is row data here
    assert got == {(1, 1): 1, (1, 2): 2, (1, 3): 2, (2, 1): 1}


def test_command_line_reports_failure(spark, scratch, capsys):
    from tidewater.__main__ import main
    import os
    local = scratch.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    ini = os.path.join(local, "db.ini")
    with open(ini, "w") as f:
        f.write("[migration]\nnation = nation_t\nno_such_table = x_t\n")
    code = main(["migrate", "--settings", ini, "--source-root", "/root/testdata/sf0.001",
                 "--target-root", f"{scratch}/t"])
    out = capsys.readouterr().out
    assert code == 1 and "no_such_table\tfailed" in out and "nation\tok" in out


def test_bucketed_layout_is_kept(spark, scratch):
    import pytest
    from tidewater.sinks.bucketed import read_bucketed, upsert_bucketed
    root = f"{scratch}/b"
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    upsert_bucketed(rows, root, ["k"], 4)
    with pytest.raises(ValueError):
        upsert_bucketed(rows.limit(1), root, ["k"], 7)
    # a key of another type is cast to the stored one before it is hashed
    upsert_bucketed(spark.sql("select 5 as k, 'b' as v"), root, ["k"], 4)
    got = {r.k: r.v for r in read_bucketed(spark, root).collect()}
    assert len(got) == 100 == read_bucketed(spark, root).count() and got[5] == "b"


def test_a_failed_bucketed_load_leaves_the_old_table(spark, scratch, monkeypatch):
    import pytest
    from tidewater.sinks import bucketed
    root = f"{scratch}/b"
    rows = spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    bucketed.upsert_bucketed(rows, root, ["k"], 4)
    before = bucketed.read_bucketed(spark, root)
    def broken(*a, **b):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(bucketed, "publish", broken)  # the bucket files are written, the manifest is not
        with pytest.raises(RuntimeError):
            bucketed.upsert_bucketed(rows.withColumn("v", F.lit("b")), root, ["k"], 4)
    assert {r.v for r in bucketed.read_bucketed(spark, root).collect()} == {"a"} == {r.v for r in before.collect()}
    bucketed.upsert_bucketed(rows.limit(1).withColumn("v", F.lit("c")), root, ["k"], 4)
    assert bucketed.read_bucketed(spark, root).filter("v = 'c'").count() == 1
    assert bucketed.read_bucketed(spark, root).count() == 50


def test_maps_can_be_loaded(spark, scratch):
    from tidewater.operators.upsert import affected_rows, upsert
    old = spark.sql("select 1 as k, map('a', 1) as m, 1 as ver")
    new = spark.sql("select 1 as k, map('a', 2) as m, 2 as ver union all select 2, map('b', 1), 1")
    assert upsert(old, new, ["k"], order_by=["ver", "m"]).count() == 2
    got = {r.k: r.change for r in affected_rows(old, new, ["k"], ["ver", "m"]).collect()}
    assert got == {1: "update", 2: "insert"}


def test_state_that_cannot_be_read_fails_the_run(spark, scratch, monkeypatch):
    import pytest
    from tidewater.sinks import control
    assert control.read_state(spark, f"{scratch}/none") == {}
    def denied(*a):
        raise PermissionError("denied")
    monkeypatch.setattr(control, "read_current", denied)
    with pytest.raises(PermissionError):
        control.read_state(spark, f"{scratch}/none")


def test_no_local_scratch_folder_on_a_cluster():
    import pytest
    from tidewater.session import checkpoint_root
    class Conf:
        def get(self, *a):
            return None
    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None
    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError):
        checkpoint_root(Session())


def _fake_database(monkeypatch, fail=False):
    """Records what the JDBC sink would write and run; there is no database here."""
    from tidewater.sinks import jdbc
    log = []
    def execute(df, url, statements, properties=None):
        log.extend(statements)
        if fail and statements[0].startswith("INSERT"):
            raise RuntimeError("duplicate entry")
        return [7] * len(statements)
    monkeypatch.setattr(jdbc, "execute", execute)
    monkeypatch.setattr(jdbc, "_write_staging", lambda rows, url, staging, props: log.append((staging, rows.count())))
    return log


def test_migration_into_a_relational_target(spark, scratch, monkeypatch):
    from tidewater.plans.migration import migrate_all
    from tidewater.spec import MigrationSpec, TableSpec
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, v string, ts int").write.parquet(f"{scratch}/t")
    def run(target):
        t = TableSpec(source="t", target=target, incremental_column="ts", source_options={"path": f"{scratch}/t"},
                      sink="jdbc", sink_options={"url": "jdbc:mysql://db/x", "user": "u"})
        return migrate_all(spark, MigrationSpec([t], scratch, f"{scratch}/out", f"{scratch}/state-{target}")).first()
    log = _fake_database(monkeypatch)
    r = run("people")
    assert (r["status"], r["rows"], r["affected"], r["mark"]) == ("ok", 3, 7, "2")
    (staging, written), merge, drop = log
    assert written == 2 and staging.startswith("people_stg_") and staging in merge and "ON DUPLICATE KEY UPDATE" in merge
    assert drop == f"DROP TABLE `{staging}`"
    log = _fake_database(monkeypatch, fail=True)
    r = run("broken")
    assert (r["status"], r["failed"], r["mark"]) == ("failed", 3, None)
    assert log[-1].startswith("DROP TABLE")  # nothing stays behind


def test_relational_sink_guards(spark, monkeypatch):
    import pytest
    from tidewater.sinks.jdbc import upsert_jdbc
    log = _fake_database(monkeypatch)
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    assert upsert_jdbc(rows.limit(0), "jdbc:x", "t") == 0 and not log
    with pytest.raises(ValueError):
        upsert_jdbc(rows, "jdbc:x", "t")
    assert not log
    upsert_jdbc(spark.createDataFrame([(1,), (1,)], "id int"), "jdbc:x", "t")
    assert log[0][1] == 2 and "DUPLICATE" not in log[1]  # the server refuses the repeated key
    assert len({upsert_jdbc(rows.filter("id = 1"), "jdbc:x", "t") and log[-1] for _ in range(3)}) == 3


def test_chunk_size_becomes_read_ranges(spark, monkeypatch):
    from tidewater.sources import tables
    monkeypatch.setattr(tables, "jdbc_bounds", lambda *a: (1, 95_000))
    base = {"url": "jdbc:mysql://db/x", "dbtable": "emp", "user": "u"}
    got = tables.chunked_options(spark, base, "emp_id", 10_000)
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("emp_id", "1", "95001", "10")
    assert got["dbtable"] == "emp" and got["user"] == "u" and got["fetchsize"] == "10000"
    assert tables.chunked_options(spark, base, "emp_id", None) == base == tables.chunked_options(spark, base, None, 10)
    monkeypatch.setattr(tables, "jdbc_bounds", lambda *a: (0, 10 ** 15))
    assert tables.chunked_options(spark, base, "emp_id", 10)["numPartitions"] == str(tables.MAX_RANGES)
    monkeypatch.setattr(tables, "jdbc_bounds", lambda *a: None)
    assert tables.chunked_options(spark, base, "emp_id", 10) == base
