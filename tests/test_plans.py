"""Plan properties that must hold: pushdown, shuffle count, broadcasts, no Python."""

import re

import pytest

import __spark_entry__ as E
from tidewater.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan):
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning)", plan))


def test_mark_predicate_is_pushed_into_the_scan(spark):
    plan = _plan(spark, "incremental_extract")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan
    assert _shuffles(plan) == 0


def test_small_upsert_never_shuffles_the_target(spark):
    plan = _plan(spark, "upsert_merge")
    assert _shuffles(plan) == 0 and "BroadcastExchange" in plan


def test_event_chain_shuffles(spark):
    plan = _plan(spark, "event_ingest_e2e")
    # rebalance before parsing (input is one split here), dedup, lookup de-dup
    assert _shuffles(plan) <= 3
    assert "BroadcastHashJoin" in plan
    assert plan.count("parseJson") == 1          # each message parsed once


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|PythonUDF)", plan)


def test_small_batch_accounting_does_not_shuffle_the_target(spark):
    from tidewater.operators.upsert import affected_rows
    target = spark.read.parquet(f"{SF}/customer.parquet")
    batch = target.where("c_custkey < 20").select("c_custkey", "c_name", "c_acctbal")
    df = affected_rows(target.select("c_custkey", "c_name", "c_acctbal"), batch, ["c_custkey"], [],
                       unique_keys=True, small_batch=True)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan
    assert _shuffles(plan) == 0 or "BroadcastHashJoin" in plan


def test_keep_first_aggregates_before_the_shuffle(spark):
    """A key holding a third of the rows is reduced map-side (partial min_by)."""
    from pyspark.sql import functions as F
    from tidewater.operators.dedup import keep_first
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    out = keep_first(df, ["k"], ["seq"])
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    hot = out.where("k = -1").first()
    assert (hot.seq, hot.v) == (0, 0) and out.count() == 20001
