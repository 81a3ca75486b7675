"""Splits and samples against brute force, with heavy repeats."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyframe.operators import split

SCHEMA = "n long, Class int"


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def unique(spark, n, every=3):
    return spark.range(n).select(F.col("id").alias("n"), (F.col("id") % every == 0).cast("int").alias("Class"))


def with_hot_copies(spark, n):
    """A third of all rows are copies of one row."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("n"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2).cast("int").alias("Class"),
    )


def test_sizes():
    assert split.split_sizes(539_382) == (377_566, 80_908, 80_908)
    assert split.largest_remainder({0: 5, 1: 3, 2: 2}, 4) == {0: 2, 1: 1, 2: 1}


@pytest.mark.parametrize("digits", [3, 1])
def test_split_matches_brute_force(spark, monkeypatch, digits):
    monkeypatch.setattr(split, "DIGITS", digits)
    df = unique(spark, 5003)
    got = {r["n"]: r["split"] for r in split.stratified_split(df, key=("n",)).collect()}
    train, val, test = split.split_sizes(5003)
    counts = Counter(0 if i % 3 else 1 for i in range(5003))
    rest = split.largest_remainder(counts, 5003 - test)
    fit = split.largest_remainder(rest, train)
    want = {}
    for c in (0, 1):
        rows = sorted((i for i in range(5003) if (i % 3 == 0) == bool(c)), key=lambda i: md5(i, 42))
        n_test, n_val = counts[c] - rest[c], rest[c] - fit[c]
        for rank, i in enumerate(rows):
            want[i] = "test" if rank < n_test else "val" if rank < n_test + n_val else "train"
    assert got == want
    assert Counter(got.values()) == {"train": train, "val": val, "test": test}


def test_split_of_copies_keeps_exact_sizes_and_all_rows(spark):
    df = with_hot_copies(spark, 3000).cache()
    parts = split.stratified_split(df)
    sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert (sizes["train"], sizes["val"], sizes["test"]) == split.split_sizes(3000)
    assert Counter(map(tuple, parts.drop("split").collect())) == Counter(map(tuple, df.collect()))
    rate = {r["split"]: r["r"] for r in parts.groupBy("split").agg(F.avg("Class").alias("r")).collect()}
    assert max(rate.values()) - min(rate.values()) < 0.02


@pytest.mark.parametrize("size", [1, 700, 1999])
def test_samples_of_copies_are_exact(spark, size):
    df = with_hot_copies(spark, 2000).cache()
    for chosen in (split.sample_n(df, size), split.stratified_sample(df, size)):
        rows = Counter(map(tuple, chosen.collect()))
        assert sum(rows.values()) == size
        assert not rows - Counter(map(tuple, df.collect()))


def test_rows_that_are_all_the_same(spark):
    df = spark.range(1000).select(F.lit(7).cast("long").alias("n"), F.lit(1).alias("Class"))
    sizes = {r["split"]: r["count"] for r in split.stratified_split(df).groupBy("split").count().collect()}
    assert sizes == {"train": 700, "val": 150, "test": 150}


def test_same_rows_on_every_run_and_layout(spark):
    df = unique(spark, 2000)
    first = split.stratified_split(df)
    again = split.stratified_split(df.repartition(7, F.rand(1)))
    assert {tuple(r) for r in first.collect()} == {tuple(r) for r in again.collect()}
    other = split.stratified_split(df, seed=7)
    assert {tuple(r) for r in first.collect()} != {tuple(r) for r in other.collect()}


def test_small_frames_are_returned_whole(spark):
    assert split.sample_n(unique(spark, 10), 10).count() == 10
    assert split.stratified_sample(unique(spark, 10), 11).count() == 10


def test_folds_are_stratified(spark):
    folds = split.stratified_folds(unique(spark, 1000), 3).groupBy("fold", "Class").count().collect()
    sizes = {(r["fold"], r["Class"]): r["count"] for r in folds}
    assert len(sizes) == 6
    for c in (0, 1):
        mine = [sizes[f, c] for f in range(3)]
        assert max(mine) - min(mine) <= 1


def test_many_classes(spark):
    df = spark.range(900).select(F.col("id").alias("n"), (F.col("id") % 150).cast("int").alias("Class"))
    sizes = {r["split"]: r["count"] for r in split.stratified_split(df).groupBy("split").count().collect()}
    assert (sizes["train"], sizes["val"], sizes["test"]) == split.split_sizes(900)


def test_repeated_keys_never_bring_their_rows_to_the_driver(spark, monkeypatch):
    """400,000 different rows under three keys."""
    most = 0
    real = type(spark.range(1))
    collect = real.collect

    def counted(df):
        nonlocal most
        rows = collect(df)
        most = max(most, len(rows))
        return rows

    df = spark.range(400_000).select((F.col("id") % 3).alias("n"), F.col("id").alias("other"), (F.col("id") % 2).cast("int").alias("Class"))
    monkeypatch.setattr(real, "collect", counted)
    parts = split.stratified_split(df, key=("n",))
    monkeypatch.undo()
    assert most <= 4 * 4096
    sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert (sizes["train"], sizes["val"], sizes["test"]) == split.split_sizes(400_000)


def test_assignment_is_a_projection(spark):
    plan = split.stratified_split(unique(spark, 5000))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
