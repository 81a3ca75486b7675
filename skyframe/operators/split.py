"""Exact, seeded splits and samples.

Every row gets a key, the md5 of its content and the seed. Rows with the smallest
keys of a class form the test set, the next ones the validation set, and so on. Only
the keys at which one set ends and the next begins are searched for, by counting rows
per key prefix and looking closer at the prefix that holds the cut. Assigning rows is
then a projection that compares a key with literals: the data itself is never sorted
or shuffled, and the same rows are chosen on every run.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K

DIGITS = 3
HEAD = 32


def content_md5(columns: Sequence[str], seed: int, key: Sequence[str] = ()) -> Column:
    """Hex digest of the ``key`` columns, or of the whole row, and the seed."""
    if not key:
        return F.md5(F.concat(F.to_json(F.struct(*columns)), F.lit(f"|{seed}")))
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))


def row_key(columns: Sequence[str], seed: int, key: Sequence[str] = ()) -> Column:
    """Hex key of a row. Rows with equal keys are equal in every column.

    ``key`` names columns that order the rows; the whole row only breaks their ties.
    """
    whole = content_md5(columns, seed)
    return F.concat(content_md5(columns, seed, key), whole) if key else whole


def largest_remainder(counts: dict, total: int) -> dict:
    """Share ``total`` over the classes in proportion, whole rows, leftovers to the largest fractions."""
    n = sum(counts.values())
    floors = {c: (k * total) // n for c, k in counts.items()}
    order = sorted(counts, key=lambda c: (-((counts[c] * total) % n), c))
    for c in order[: total - sum(floors.values())]:
        floors[c] += 1
    return floors


def split_sizes(n: int, val: float = K.VAL_SHARE, test: float = K.TEST_SHARE) -> tuple[int, int, int]:
    """(train, val, test) rows: test is rounded up first, then validation out of the rest."""
    n_test = math.ceil(test * n)
    n_val = math.ceil(val / (1 - test) * (n - n_test))
    return n - n_test - n_val, n_val, n_test


class _Search:
    """One cut being located: the ``target``-th smallest key of a stratum."""

    def __init__(self, stratum, target: int, head_only: bool):
        self.stratum, self.target, self.head_only = stratum, target, head_only
        self.prefix, self.before = "", 0
        self.alike, self.key, self.take, self.copies = False, None, None, None

    def mine(self) -> Column:
        return F.col("_stratum").eqNullSafe(F.lit(self.stratum))

    def matches(self, whole: Column) -> Column:
        """Rows under the prefix. The whole key is computed only where heads are equal."""
        head = self.mine() & F.col("_head").startswith(self.prefix[:HEAD])
        return head & whole.startswith(self.prefix) if len(self.prefix) > HEAD else head

    def looks_at(self, whole: Column) -> Column:
        """What the next digits are taken from: the head or, once it is known, the whole key."""
        return F.col("_head") if self.head_only or len(self.prefix) < HEAD else whole

    def longer(self, whole: Column) -> Column:
        """The next three digits, or all of them if all rows under the prefix agree."""
        key = self.looks_at(whole)
        return key if self.alike else F.substring(key, 1, len(self.prefix) + DIGITS)

    def covers(self, whole: Column) -> Column:
        """Rows up to and with the cut. The whole key is computed only where heads are equal."""
        head = self.key[:HEAD]
        return self.mine() & ((F.col("_head") < head) | ((F.col("_head") == head) & (whole <= self.key)))

    def is_at(self, whole: Column) -> Column:
        return self.mine() & (F.col("_head") == self.key[:HEAD]) & (whole == self.key)

    def narrow(self, counts: dict) -> None:
        """Step into the counted prefix that holds the target."""
        seen = self.before
        for prefix in sorted(p for s, p in counts if s == self.stratum and p.startswith(self.prefix)):
            n, alike = counts[self.stratum, prefix]
            if seen + n >= self.target:
                if self.alike and (self.head_only or len(self.prefix) >= HEAD):
                    self.key, self.take, self.copies = prefix, self.target - seen, n
                # With the whole head known, the digits behind it have not been compared yet.
                self.alike = alike and (self.head_only or not len(self.prefix) < HEAD <= len(prefix))
                self.prefix, self.before = prefix, seen
                return
            seen += n
        raise ValueError("fewer rows than asked for")


def _locate(keyed: DataFrame, whole: Column, searches: list[_Search]) -> None:
    """Narrow every search until its key is known.

    Each round looks at three more digits, so it returns at most 4,096 counts per cut. With a
    count comes whether all its rows have the same key; only then is the key itself asked for,
    which is one more count, however many rows share it. Rows away from every cut have no prefix
    and merge into one count per task.
    """
    while open_searches := [s for s in searches if s.key is None]:
        prefix, name = F.when(F.lit(False), F.col("_head")), F.when(F.lit(False), F.lit(0).cast("long"))
        for s in open_searches:
            prefix = prefix.when(s.matches(whole), s.longer(whole))
            name = name.when(s.matches(whole), F.xxhash64(s.looks_at(whole)))
        counted = (
            keyed.select("_stratum", prefix.alias("p"), name.alias("k"))
            .where("p IS NOT NULL")
            .groupBy("_stratum", "p")
            .agg(F.count("*").alias("n"), F.min("k").alias("least"), F.max("k").alias("most"))
        )
        counts = {(r["_stratum"], r["p"]): (r["n"], r["least"] == r["most"]) for r in counted.collect()}
        for s in open_searches:
            s.narrow(counts)


def _assign(
    df: DataFrame,
    stratum: Column,
    seed: int,
    key: Sequence[str],
    plan_of: Callable[[dict], dict | None],
    names: Sequence[str],
    column: str,
) -> DataFrame:
    """Label rows with ``names`` in key order, leftovers with the last one.

    ``plan_of`` turns {stratum: rows} into {stratum: [rows per name]}. Without a plan every row
    gets the first name. The driver holds one count per stratum and a key per cut.
    """
    whole = row_key(df.columns, seed, key)
    keyed = df.withColumn("_stratum", stratum).withColumn("_head", content_md5(df.columns, seed, key))
    sizes = keyed.groupBy("_stratum").agg(F.count("*").alias("n")).collect()
    plan = plan_of({r["_stratum"]: r["n"] for r in sizes})
    if plan is None:
        return df.withColumn(column, F.lit(names[0]))
    searches = {}
    for s, parts in plan.items():
        for i, upto in enumerate(itertools.accumulate(parts)):
            if parts[i]:
                searches[s, i] = _Search(s, upto, not key)
    _locate(keyed, whole, list(searches.values()))

    label = F.when(F.lit(False), names[-1])
    shared = {}
    for (s, i), cut in searches.items():
        label = label.when(cut.covers(whole), names[i])
        if cut.take < cut.copies:
            shared[s, cut.key] = cut
    labelled = keyed.withColumn(column, label.otherwise(names[-1]))
    if not shared:
        return labelled.drop("_stratum", "_head")

    # Copies of one identical row fall on both sides of a cut. They are told apart by
    # number: the row is repeated over a distributed range and each number gets its label.
    parts = []
    for (s, k), cut in shared.items():
        number = F.when(F.lit(False), names[-1])
        for (s2, i), other in searches.items():
            if s2 == s and other.key == k:
                number = number.when(F.col("_n") < other.take, names[i])
        one = keyed.where(cut.is_at(whole)).limit(1)
        copies = (
            df.sparkSession.range(cut.copies)
            .withColumnRenamed("id", "_n")
            .withColumn("_head", F.lit(k[:HEAD]))
            .withColumn(column, number.otherwise(names[-1]))
        )
        # A single row by construction.
        parts.append(copies.join(F.broadcast(one), "_head").select(*df.columns, column))
    at_cut = reduce(lambda a, b: a | b, [cut.is_at(whole) for cut in shared.values()])
    rest = labelled.where(~at_cut).select(*df.columns, column)
    return reduce(DataFrame.unionByName, parts, rest)


def stratified_split(
    df: DataFrame,
    target: str = K.TARGET,
    seed: int = K.SEED,
    key: Sequence[str] = (),
    val: float = K.VAL_SHARE,
    test: float = K.TEST_SHARE,
) -> DataFrame:
    """Add ``split`` (train, val, test) with exact sizes and class shares kept."""

    def plan(counts: dict) -> dict:
        n = sum(counts.values())
        n_train, _, n_test = split_sizes(n, val, test)
        rest = largest_remainder(counts, n - n_test)
        train = largest_remainder(rest, n_train)
        return {c: [counts[c] - rest[c], rest[c] - train[c]] for c in counts}

    names = ("test", "val", "train")
    return _assign(df, F.col(target), seed, key, plan, names, "split")


def _chosen(df: DataFrame, stratum: Column, seed: int, key: Sequence[str], size: int) -> DataFrame:
    def plan(counts: dict) -> dict | None:
        if sum(counts.values()) <= size:
            return None
        return {c: [k] for c, k in largest_remainder(counts, size).items()}

    return _assign(df, stratum, seed, key, plan, ("in", "out"), "_part").where("_part = 'in'").drop("_part")


def stratified_sample(
    df: DataFrame, size: int = K.SEARCH_SAMPLE, target: str = K.TARGET, seed: int = K.SEED, key: Sequence[str] = ()
) -> DataFrame:
    """Exactly ``size`` rows with class shares kept; a smaller frame is returned whole."""
    return _chosen(df, F.col(target), seed, key, size)


def sample_n(df: DataFrame, n: int, seed: int = K.SEED, key: Sequence[str] = ()) -> DataFrame:
    """Exactly ``n`` rows without replacement, the same ones on every run."""
    return _chosen(df, F.lit("all"), seed, key, n)


def stratified_folds(
    df: DataFrame, folds: int, target: str = K.TARGET, seed: int = K.SEED, key: Sequence[str] = ()
) -> DataFrame:
    """Add ``fold`` 0..folds-1, class shares kept in each."""

    def plan(counts: dict) -> dict:
        return {c: [n // folds + (i < n % folds) for i in range(folds - 1)] for c, n in counts.items()}

    names = [str(i) for i in range(folds)]
    labelled = _assign(df, F.col(target), seed, key, plan, names, "fold")
    return labelled.withColumn("fold", F.col("fold").cast("int"))


def train_plus_val(train: DataFrame, val: DataFrame) -> DataFrame:
    return train.unionByName(val)
