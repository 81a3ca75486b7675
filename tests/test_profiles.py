"""Stored profiles: exact counts and moments, bounded ranks and distinct counts, days that add up."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyframe.operators import profile
from skyframe.session import new_folder
from skyframe.sources import files, profiles

SCHEMA = "day string, length double, n long, name string, nothing double"


def rows_of(day, count, seed):
    rng = random.Random(seed)
    return [
        (day, None if i % 50 == 0 else rng.lognormvariate(3, 1) * (1 + seed), rng.randint(0, 3000), rng.choice("abcdef") * rng.randint(1, 9), None)
        for i in range(count)
    ]


@pytest.fixture(scope="module")
def table(spark):
    rows = rows_of("d1", 9000, 1) + rows_of("d2", 30_000, 2) + rows_of("d3", 7, 3) + [("d3", float("nan"), 1, None, None), (None, 1.5, None, "", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


@pytest.fixture(scope="module")
def stored(spark, table):
    path = new_folder(spark, "profiles")
    for day in ("d1", "d2", "d3"):
        profiles.add_days(table.where(F.col("day") == day), path, "day")
    profiles.add_days(table.where("day IS NULL"), path, "day")
    return path


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_moments_of_merged_days_are_those_of_all_rows(spark, table, stored):
    got = by_column(profiles.merged(profiles.read_days(spark, stored)))
    clean = table.withColumn("length", F.when(~F.isnan("length"), F.col("length")))
    want = by_column(profile.describe(clean, ["length", "n"]))
    for c in ("length", "n"):
        assert got[c]["count"] == want[c]["count"] and got[c]["nulls"] == table.count() - want[c]["count"]
        for field in ("mean", "std", "min", "max"):
            assert math.isclose(got[c][field], want[c][field], rel_tol=1e-9)
    assert (got["nothing"]["count"], got["nothing"]["p50"], got["nothing"]["std"], got["nothing"]["distinct"]) == (0, None, None, 0)
    assert got["name"]["count"] == table.where("name IS NOT NULL").count() and got["name"]["p50"] is None


def test_ranks_and_distinct_counts_are_within_their_bounds(spark, table, stored):
    got = by_column(profiles.merged(profiles.read_days(spark, stored)))
    for c in ("length", "n"):
        values = sorted(r[0] for r in table.select(c).collect() if r[0] is not None and not math.isnan(r[0]))
        for field, p in profiles.QUARTILES.items():
            low = sum(v < got[c][field] for v in values) / len(values)
            high = sum(v <= got[c][field] for v in values) / len(values)
            assert low - profiles.RANK_ERROR <= p <= high + profiles.RANK_ERROR
    for c in ("length", "n", "name"):
        exact = table.where(~F.isnan("length") if c == "length" else F.lit(True)).agg(F.count_distinct(c)).first()[0]
        assert abs(got[c]["distinct"] - exact) <= max(1, profiles.DISTINCT_ERROR * exact)


def test_histogram_shares(spark, table, stored):
    got = profiles.histogram(profiles.read_days(spark, stored), "n", 13).orderBy("bin").collect()
    values = [r[0] for r in table.where("n IS NOT NULL").select("n").collect()]
    assert len(got) == 13 and math.isclose(sum(r["share"] for r in got), 1.0)
    for r in got:
        inside = sum(r["low"] <= v < r["high"] or r["bin"] == 12 and v == r["high"] for v in values) / len(values)
        assert abs(r["share"] - inside) <= 2 * profiles.RANK_ERROR
    assert profiles.histogram(profiles.read_days(spark, stored), "nothing", 4).count() == 0


def test_a_day_again_replaces_itself_and_touches_no_other(spark, table):
    path = new_folder(spark, "profiles")
    profiles.add_days(table.where("day IN ('d1', 'd3')"), path, "day", ["n"])
    before = {p: t for t, p in files.matching(spark, f"{path}/day=d1/*.parquet")}
    profiles.add_days(spark.createDataFrame(rows_of("d3", 20, 9), SCHEMA), path, "day", ["n"])
    profiles.add_days(table.where("day = 'd2'"), path, "day", ["n"])
    assert {p: t for t, p in files.matching(spark, f"{path}/day=d1/*.parquet")} == before and before
    counts = {r["day"]: r["rows"] for r in profiles.read_days(spark, path).collect()}
    assert counts == {"d1": 9000, "d2": 30_000, "d3": 20}
    some = profiles.read_days(spark, path, ["d1", "d3"])
    assert profiles.merged(some).first()["count"] == 9020
    assert "PartitionFilters: [day" in some._jdf.queryExecution().executedPlan().toString()


def test_no_rows(spark, table):
    path = new_folder(spark, "profiles")
    profiles.add_days(table.where("false"), path, "day")
    assert not files.exists(spark, f"{path}/day=d1")
