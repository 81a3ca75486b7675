"""Running totals, metrics and quantiles against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyframe.functions import ordering
from skyframe.functions.ordering import running_totals
from skyframe.operators import metrics, profile

finite = st.floats(allow_nan=False, allow_infinity=False)
few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_close_values_are_spread_over_many_ranges(spark):
    """A million values within one second: no window holds more than a few times its share."""
    df = spark.range(1_000_000).select((F.lit(1.7e9) + F.col("id") / 1e6).alias("x"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ordering._ranges(df, [F.asc("x")]).groupBy("_range").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 2 * 250_000
    assert running_totals(df, "x", ["n"]).agg(F.max("n_upto"), F.sum(F.col("n_upto").cast("double"))).first()[0] == 1_000_000


def test_numbers_follow_the_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randrange(10**6)) for _ in range(3000)]
    got = ordering.numbered(spark.createDataFrame(rows, "g string, x long").repartition(9), ["x"], "i", ["g"]).collect()
    for g in "ab":
        mine = sorted((r["i"], r["x"]) for r in got if r["g"] == g)
        assert [i for i, _ in mine] == list(range(1, len(mine) + 1))
        assert [x for _, x in mine] == sorted(x for h, x in rows if h == g)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = random.Random(3)
    values = {rng.choice([rng.uniform(-1, 1), rng.gauss(0, 1e6), rng.uniform(0, 1e-9), 0.0]) for _ in range(500)}
    edges = {1.0, math.nextafter(1, 0), math.nextafter(1, 2), 2.0, math.nextafter(2, 0), 5e-324, -5e-324}
    rows = [(g, v, rng.randrange(5)) for g in "ab" for v in values | edges]
    df = spark.createDataFrame(rows, "g string, x double, n long").repartition(8)
    got = {(r["g"], r["x"]): r["n_upto"] for r in running_totals(df, "x", ["n"], ["g"], descending).collect()}
    for g in "ab":
        total = 0
        for _, v, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending):
            total += n
            assert got[g, v] == total


def brute(y, p):
    y, p = np.array(y), np.array(p)
    pos, neg = p[y == 1], p[y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    steps, last = 0.0, 0
    for t in sorted(set(p), reverse=True):
        tp = int(((p >= t) & (y == 1)).sum())
        steps += (tp - last) * tp / (p >= t).sum()
        last = tp
    hit = p >= 0.5
    tp = int((hit & (y == 1)).sum())
    precision = tp / hit.sum() if hit.sum() else 0.0
    recall = tp / len(pos)
    return {
        "accuracy": float((hit == (y == 1)).mean()),
        "precision": precision,
        "recall": recall,
        "f1": 2 * precision * recall / (precision + recall) if tp else 0.0,
        "roc_auc": wins / (len(pos) * len(neg)),
        "pr_auc": steps / len(pos),
    }


@few
@given(
    rows=st.lists(st.tuples(st.integers(0, 1), st.one_of(st.floats(0, 1), st.sampled_from([0.1, 0.5, 0.9]))), max_size=40)
)
def test_metrics(spark, rows):
    rows = [*rows, (1, 0.5), (0, 0.25)]
    scored = spark.createDataFrame(rows, "Class int, probability_delayed double")
    got = metrics.classification_metrics(scored).first().asDict()
    assert got == pytest.approx(brute(*zip(*rows)))


def test_average_precision_is_a_step_sum(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.7), (0, 0.4), (1, 0.2)]
    got = metrics.classification_metrics(spark.createDataFrame(rows, "Class int, probability_delayed double")).first()
    assert got["pr_auc"] == pytest.approx(0.25 * 1 + 0.5 * 0.75 + 0.25 * 4 / 6)


def test_one_class_has_no_rank_metric(spark):
    got = metrics.classification_metrics(spark.createDataFrame([(0, 0.1), (0, 0.2)], "Class int, probability_delayed double")).first()
    assert got["roc_auc"] is None and got["recall"] == got["precision"] == 0.0 and got["accuracy"] == 1.0


def test_groups_are_kept_apart(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(2), round(rng.random(), 1)) for g in "abc" for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, Class int, probability_delayed double")
    for r in metrics.classification_metrics(df, within=["g"]).collect():
        want = brute(*zip(*[(y, p) for g, y, p in rows if g == r["g"]]))
        assert {k: r[k] for k in want} == pytest.approx(want)


def test_empty_cells_of_the_confusion_matrix(spark):
    cells = metrics.confusion_matrix(spark.createDataFrame([(0, 0)], "Class int, predicted_class int")).collect()
    assert {(r["actual_label"], r["predicted_label"]): r["flights"] for r in cells} == {
        ("On-time", "On-time"): 1,
        ("On-time", "Delayed"): 0,
        ("Delayed", "On-time"): 0,
        ("Delayed", "Delayed"): 0,
    }


def test_roc_points_run_from_the_origin_to_the_corner(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.6), (0, 0.1)]
    points = metrics.roc_points(spark.createDataFrame(rows, "Class int, probability_delayed double")).collect()
    got = {r["threshold"]: (r["fpr"], r["tpr"]) for r in points}
    assert got == {None: (0.0, 0.0), 0.9: (0.5, 0.5), 0.6: (0.5, 1.0), 0.1: (1.0, 1.0)}


@few
@given(values=st.lists(st.one_of(st.floats(-1e9, 1e9), st.integers(-3, 3).map(float)), min_size=1, max_size=50))
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = profile.exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.9, 1.0)).first()
    assert list(row[1:]) == pytest.approx(list(np.quantile(values, [0, 0.25, 0.5, 0.9, 1])), rel=1e-9, abs=1e-9)


def test_describe_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "y"), (4.0, "z")], "x double, s string")
    row = profile.describe(df).first()
    assert (row["column"], row["count"], row["mean"], row["min"], row["p50"], row["max"]) == ("x", 2, 2.5, 1.0, 2.5, 4.0)
    assert row["std"] == pytest.approx(np.std([1, 4], ddof=1))


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v), 0) for v in (0, 1, 5, 10, 10)], "x double, Class int")
    bins = {r["bin"]: r["flights"] for r in profile.histogram_by_class(df, "x", 10).collect()}
    assert bins == {**dict.fromkeys(range(10), 0), 0: 1, 1: 1, 5: 1, 9: 2}
