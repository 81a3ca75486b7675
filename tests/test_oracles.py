"""Every registered query that has an SQL twin gives the same rows."""

import pytest

import __spark_entry__ as entry
from oracle import connect, difference

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    with connect(sf_dir) as c:
        yield c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    # No pair of rows without a join key, and nothing leaves the JVM.
    for operator in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert operator not in plan


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == [
        "icao24", "callsign", "longitude", "latitude", "on_ground", "true_track", "vertical_rate", "updated_at",
    ]
    assert rows.count() > 0
