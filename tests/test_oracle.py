"""Every registered query against its SQL oracle (DuckDB) on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from compare_oracle import duck, rows_of  # noqa: E402
from tidewater.catalog import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "user_id", "timestamp", "payload", "user_name", "user_location",
                          "event_date"]
