"""Fused upsert with accounting, files pruned by key statistics, optimistic commits."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewater.operators.upsert import affected_rows, collapse_versions, load_metrics, merge_counted, upsert
from tidewater.plans import migration
from tidewater.plans.migration import migrate_all
from tidewater.sinks import bucketed, versioned
from tidewater.sinks.bucketed import merge_bucketed, read_bucketed
from tidewater.sinks.control import append_control, read_control, read_state
from tidewater.sinks.versioned import CommitConflict, current_version, publish, read_current
from tidewater.spec import MigrationSpec, TableSpec

SCHEMA = "id long, name string, value long, ver int"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _batch(spark, seed, keys=30, rows=120):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.randrange(keys), rng.choice(["a", "b", None]), rng.choice([1, 2, None]), i)
                                  for i in range(rows)], SCHEMA)


@pytest.mark.parametrize("skew_safe", [False, True])
@pytest.mark.parametrize("with_target", [True, False])
def test_fused_merge_equals_upsert_and_accounting(spark, skew_safe, with_target):
    batch = _batch(spark, 1)
    target = spark.createDataFrame([(i, "a", 1, 0, "kept") for i in range(0, 60, 2)], SCHEMA + ", note string") if with_target else None
    compared = [c for c in batch.columns if c != "id"]
    merged = merge_counted(target, collapse_versions(batch, ["id"], ["ver"], compared, skew_safe=skew_safe, partitions=9), ["id"])
    assert _rows(merged.drop("_affected", "_null_rows")) == _rows(upsert(target, batch, ["id"], order_by=["ver"]))
    counts = merged.agg(*load_metrics()).first()
    expected = affected_rows(target, batch, ["id"], ["ver"], skew_safe=False).agg(F.sum("affected")).first()[0]
    assert (counts["affected"], counts["null_keys"]) == (expected, 0)


@pytest.mark.parametrize("skew_safe", [False, True])
def test_a_key_with_a_third_of_the_versions(spark, skew_safe):
    batch = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
                                     (F.col("id") % 2).cast("string").alias("name"), F.col("id").alias("ver"))
    changes = collapse_versions(batch, ["id"], ["ver"], ["name"], skew_safe=skew_safe, partitions=8)
    hot = changes.where("id = -1").first()
    assert (hot["_n"], hot["_steps"], hot["ver"], hot["_first"]["name"]) == (1000, 999, 2997, "0")
    assert changes.count() == 2001


def test_null_keys_are_counted(spark):
    batch = spark.createDataFrame([(None, "a", 1, 1), (None, "b", 1, 2), (1, "c", 1, 3)], SCHEMA)
    target = spark.createDataFrame([(1, "c", 1, 0)], SCHEMA)
    for t in (None, target):
        changes = collapse_versions(batch, ["id"], ["ver"], ["name", "value", "ver"])
        assert merge_counted(t, changes, ["id"]).agg(*load_metrics()).first()["null_keys"] == 2


def test_load_is_one_join_of_one_read_each(spark, scratch):
    spark.range(1000).select("id", F.lit("t").alias("name")).write.parquet(f"{scratch}/target")
    spark.range(500, 1500).select("id", F.lit("s").alias("name")).write.parquet(f"{scratch}/batch")
    target, batch = spark.read.parquet(f"{scratch}/target"), spark.read.parquet(f"{scratch}/batch")
    merged = merge_counted(target, collapse_versions(batch, ["id"], ["name"], ["name"]), ["id"])
    merged.write.format("noop").mode("overwrite").save()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin", plan)) == 1
    assert plan.count("FileScan parquet") == 2
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


# ---------------------------------------------------------------- files pruned by key statistics

def _load(batch, root, keys, buckets=4, **options):
    rest = [c for c in batch.columns if c not in keys]
    return merge_bucketed(collapse_versions(batch, keys, rest, rest).checkpoint(), root, keys, buckets, **options)


def _table(spark, n, **columns):
    return spark.range(n).select((F.col("id") * 7).alias("k"), F.concat(F.lit("n"), F.col("id")).alias("v"))


def test_an_update_rewrites_the_files_of_its_keys_only(spark, scratch):
    from tidewater.session import checkpoint_root
    checkpoint_root(spark)
    root = f"{scratch}/t"
    first = _load(_table(spark, 40_000), root, ["k"], file_rows=100)
    assert (first.affected, first.files, first.rewritten) == (40_000, 0, 0)
    files = len(bucketed._manifest(spark, root).files)
    assert files >= 400
    keys = random.Random(3).sample(range(40_000), 40)
    update = spark.createDataFrame([(7 * i, "new") for i in keys], "k long, v string")
    load = _load(update, root, ["k"], file_rows=100)
    assert load.affected == 80 and load.files == files and 20 <= load.rewritten <= 60
    got = {r.k: r.v for r in read_bucketed(spark, root).collect()}
    assert len(got) == 40_000 and all(got[7 * i] == "new" for i in keys) and got[7 * next(i for i in range(40_000) if i not in keys)] != "new"
    # the same again changes nothing
    assert _load(update, root, ["k"], file_rows=100).affected == 0


def test_new_keys_inside_the_ranges_rewrite_almost_nothing(spark, scratch):
    root = f"{scratch}/t"
    _load(_table(spark, 20_000), root, ["k"], file_rows=1000)
    new = spark.createDataFrame([(7 * i + 3, "gap") for i in range(0, 20_000, 200)], "k long, v string")
    load = _load(new, root, ["k"], file_rows=1000)
    # 100 keys, each between two keys of some file; the filters err for about one in a hundred
    assert load.affected == 100 and load.files >= 20 and load.rewritten <= 5
    assert read_bucketed(spark, root).count() == 20_100
    assert {r.k for r in read_bucketed(spark, root).where("v = 'gap'").collect()} == {7 * i + 3 for i in range(0, 20_000, 200)}


def test_small_files_are_rewritten_together(spark, scratch, monkeypatch):
    monkeypatch.setattr(bucketed, "MAX_SMALL_FILES", 3)
    root = f"{scratch}/t"
    sizes = []
    for i in range(6):
        _load(spark.createDataFrame([(i, "x")], "k long, v string"), root, ["k"], buckets=1)
        sizes.append(len(bucketed._manifest(spark, root).files))
    assert sizes == [1, 2, 3, 1, 2, 3] and read_bucketed(spark, root).count() == 6


def test_files_of_expired_versions_go_and_leftovers_wait(spark, scratch):
    from tidewater import paths
    from tidewater.sinks.versioned import version_paths
    root = f"{scratch}/t"
    for i in range(6):
        _load(spark.createDataFrame([(k, f"v{i}") for k in range(40)], "k long, v string"), root, ["k"], file_rows=10)
    runs = {name for name, _, _ in paths.list_dir(spark, f"{root}/data")}
    assert len(version_paths(spark, f"{root}/_manifest")) == versioned.DEFAULT_KEEP == len(runs)
    assert len(paths.list_dir(spark, f"{root}/index")) == versioned.DEFAULT_KEEP
    spark.range(3).write.parquet(f"{root}/data/lost")
    assert bucketed.remove_leftovers(spark, root) == []
    assert bucketed.remove_leftovers(spark, root, older_than=-5) == ["data/lost"]
    assert {r.v for r in read_bucketed(spark, root).collect()} == {"v5"} and read_bucketed(spark, root).count() == 40


def test_keys_of_several_columns_and_other_names(spark, scratch):
    root = f"{scratch}/t"
    batch = spark.range(300).select(F.concat(F.lit("p"), F.col("id") % 7).alias("path"), F.col("id").alias("key"),
                                    F.lit(1).alias("bucket"), F.lit("v").alias("rows"))
    _load(batch, root, ["path", "key"], file_rows=20)
    load = _load(batch.where("key % 50 = 0").withColumn("rows", F.lit("w")), root, ["path", "key"], file_rows=20)
    assert load.affected == 12 and 0 < load.rewritten < load.files
    assert read_bucketed(spark, root).where("rows = 'w'").count() == 6 and read_bucketed(spark, root).count() == 300


def test_a_target_can_gain_columns(spark, scratch):
    for buckets in (None, 2):
        root = f"{scratch}/{buckets}"
        spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(f"{root}/s1")
        spark.createDataFrame([(2, "c", 5)], "id long, v string, x long").write.parquet(f"{root}/s2")

        def run(path, add):
            t = TableSpec(source="s", target="t", source_options={"path": f"{root}/{path}"}, buckets=buckets, add_columns=add)
            return migrate_all(spark, MigrationSpec([t], root, f"{root}/out", f"{root}/ctl")).first()
        assert run("s1", False).status == "ok" and run("s2", False).status == "failed"
        assert run("s2", True).affected == 2
        back = read_bucketed(spark, f"{root}/out/t") if buckets else read_current(spark, f"{root}/out/t")
        assert _rows(back.select("id", "v", "x")) == [(1, "a", None), (2, "c", 5)]


# ---------------------------------------------------------------- optimistic commits

def test_a_commit_from_an_old_version_is_a_conflict(spark, scratch):
    root = f"{scratch}/t"
    one = spark.range(1)
    base = publish(one, root, base=None)
    with pytest.raises(CommitConflict):
        publish(one, root, base=None)
    newer = publish(one, root, base=base)
    with pytest.raises(CommitConflict):
        publish(one, root, base=base)
    assert current_version(spark, root) == newer
    for _ in range(5):  # the number after `base` expires, and stays taken
        publish(one, root)
    with pytest.raises(CommitConflict):
        publish(one, root, base=base)
    assert read_current(spark, root).count() == 1 and len(versioned._folders(spark, root)) == versioned.DEFAULT_KEEP


def test_tables_without_commit_files_are_taken_over(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/t/v=00000004.aaaa")
    assert read_current(spark, f"{scratch}/t").count() == 3
    publish(spark.range(5), f"{scratch}/t", base=current_version(spark, f"{scratch}/t"))
    assert read_current(spark, f"{scratch}/t").count() == 5
    assert len(versioned.version_paths(spark, f"{scratch}/t")) == 2


def _marks(spark, *rows):
    return spark.createDataFrame(rows, "table_name string, hwm_value string, hwm_type string")


def test_overlapping_runs_keep_both_marks(spark, scratch):
    path = f"{scratch}/ctl"
    append_control(_marks(spark, ("a", "10", "bigint"), ("b", "10", "bigint")), path, "seed")
    start = read_state(spark, path)
    append_control(_marks(spark, ("a", "90", "bigint"), ("c", "1", "bigint")), path, "one", base=start)
    append_control(_marks(spark, ("a", "100", "bigint"), ("b", "20", "bigint")), path, "two", base=start)
    append_control(_marks(spark, ("a", "95", "bigint")), path, "three", base=start)
    got = {r["table_name"]: r["hwm_value"] for r in read_control(spark, path).collect()}
    assert got == {"a": "100", "b": "20", "c": "1"}


def test_marks_overtaken_during_the_commit_are_merged(spark, scratch, monkeypatch):
    from tidewater.sinks import control
    path, real, raced = f"{scratch}/ctl", control.publish, []

    def race(df, root, **options):
        if not raced:
            raced.append(1)
            append_control(_marks(spark, ("other", "7", "bigint")), path, "fast")
        return real(df, root, **options)
    monkeypatch.setattr(control, "publish", race)
    append_control(_marks(spark, ("mine", "8", "bigint")), path, "slow")
    assert {r["table_name"] for r in read_control(spark, path).collect()} == {"mine", "other"}


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_load_that_is_overtaken_is_made_again(spark, scratch, monkeypatch, buckets):
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(f"{scratch}/s1")
    spark.createDataFrame([(2, "mine"), (3, "mine")], "id long, v string").write.parquet(f"{scratch}/s2")
    spark.createDataFrame([(1, "other"), (3, "other")], "id long, v string").write.parquet(f"{scratch}/s3")

    def run(path):
        t = TableSpec(source=path, target="t", source_options={"path": f"{scratch}/{path}"}, buckets=buckets)
        return migrate_all(spark, MigrationSpec([t], scratch, f"{scratch}/out", f"{scratch}/ctl")).first()
    run("s1")
    where, name = (bucketed, "publish") if buckets else (migration, "commit")
    real, raced = getattr(where, name), []

    def race(*args, **options):
        if not raced:
            raced.append(1)
            assert run("s3").status == "ok"
        return real(*args, **options)
    monkeypatch.setattr(where, name, race)
    # both keys of the second load exist when it is made again
    assert (run("s2").affected, raced) == (4, [1])
    back = read_bucketed(spark, f"{scratch}/out/t") if buckets else read_current(spark, f"{scratch}/out/t")
    assert _rows(back) == [(1, "other"), (2, "mine"), (3, "mine")]


# ---------------------------------------------------------------- late rows

def test_differing_ranges_by_number_and_by_day(spark):
    import datetime as dt

    from tidewater.operators.reconcile import differing_ranges, in_ranges
    there = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    now = there.where("id not in (15, 95)").union(spark.sql("select 15L, 31L")).union(spark.sql("select 105L, 1L"))
    assert differing_ranges(now, there, "id", 10) == [(10, 20), (90, 110)]
    assert differing_ranges(there, there, "id", 10) == [] == differing_ranges(there.limit(0), there, "id", 10)
    # rows that come twice are told from rows that come once or not at all
    assert differing_ranges(there.union(there.where("id = 7")).union(there.where("id = 7")), there, "id", 10) == [(0, 10)]
    days = spark.createDataFrame([(dt.datetime(2024, 1, d), d) for d in (1, 2, 5)], "at timestamp_ntz, v int")
    old = days.where("v <> 2")
    assert differing_ranges(days, old, "at", "day") == [(dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))]
    got = there.where(in_ranges(F.col("id"), [(3, 5), (50, 51), (90, 200)]))
    assert sorted(r.id for r in got.collect()) == [3, 4, 50, *range(90, 100)]
    with pytest.raises(ValueError):
        differing_ranges(days, old, "at", 10)


@pytest.mark.parametrize("buckets", [None, 2])
def test_late_rows_are_found_without_a_lookback(spark, scratch, buckets):
    rows = spark.range(200).select("id", (F.col("id") * 10).alias("mark"), F.lit("a").alias("v"))
    rows.where("id <= 150 and id <> 42").write.parquet(f"{scratch}/s1")
    rows.withColumn("v", F.when(F.col("id") == 77, "b").otherwise(F.col("v"))).write.parquet(f"{scratch}/s2")

    def run(path, reconcile):
        t = TableSpec(source="s", target="t", incremental_column="mark", reconcile=reconcile, buckets=buckets,
                      columns={"mark": "m"}, source_options={"path": f"{scratch}/{path}"})
        return migrate_all(spark, MigrationSpec([t], scratch, f"{scratch}/out", f"{scratch}/ctl")).first()
    run("s1", 100)
    second = run("s2", 100)
    assert (second.rows, second.affected, second.mark) == (49 + 10 + 10, 49 + 1 + 2, "1990")
    assert run("s2", 100).status == "empty"
    back = read_bucketed(spark, f"{scratch}/out/t") if buckets else read_current(spark, f"{scratch}/out/t")
    assert back.count() == 200 and back.where("id = 77").first().v == "b"
