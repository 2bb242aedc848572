"""Property checks of the load operators against a sequential model."""

from hypothesis import given, settings, strategies as st

from tidewater.operators.upsert import affected_rows, upsert

SCHEMA = "id long, name string, value long"
ROW = st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", None]), st.integers(0, 2))


def _model(target, source):
    """Apply source rows in order; return (final table, affected per source row)."""
    table = {r[0]: r[1:] for r in target}
    counts = []
    for r in source:
        old = table.get(r[0])
        counts.append(1 if old is None else (2 if old != r[1:] else 0))
        table[r[0]] = r[1:]
    return table, counts


@settings(max_examples=12, deadline=None)
@given(st.lists(ROW, max_size=6, unique_by=lambda r: r[0]), st.lists(ROW, min_size=1, max_size=12))
def test_upsert_and_affected_match_sequential_model(spark, target, source):
    seq = [(*r, i) for i, r in enumerate(source)]
    tgt = spark.createDataFrame(target, SCHEMA)
    src = spark.createDataFrame(seq, SCHEMA + ", ver long")
    table, counts = _model(target, source)
    tgt_v = spark.createDataFrame([(*r, -1) for r in target], SCHEMA + ", ver long")
    for strategy in ("broadcast", "shuffle"):
        out = upsert(tgt_v, src, ["id"], order_by=["ver"], strategy=strategy)
        got = {r.id: (r.name, r.value) for r in out.select("id", "name", "value").collect()}
        assert got == table
    for skew_safe in (True, False):
        a = affected_rows(tgt, src, ["id"], ["ver"], partitions=3, skew_safe=skew_safe)
        assert [r.affected for r in a.orderBy("ver").collect()] == counts


@settings(max_examples=8, deadline=None)
@given(st.lists(ROW, max_size=6, unique_by=lambda r: r[0]), st.lists(ROW, min_size=1, max_size=8,
                                                                      unique_by=lambda r: r[0]))
def test_unique_key_accounting_matches_model(spark, target, source):
    tgt = spark.createDataFrame(target, SCHEMA)
    src = spark.createDataFrame([(*r, i) for i, r in enumerate(source)], SCHEMA + ", ver long")
    _, counts = _model(target, source)
    a = affected_rows(tgt, src, ["id"], ["ver"], unique_keys=True)
    assert [r.affected for r in a.orderBy("ver").collect()] == counts
    b = affected_rows(None, src, ["id"], ["ver"], unique_keys=True)
    assert [r.affected for r in b.collect()] == [1] * len(source)
