"""The operators on vectors against brute force, on small tables with every awkward case."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframe.llm import hard_negatives, nn_descent, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
#: Columns whose names the operators use themselves.
CLASHES = "id vec x n node weight least unit small cell place block group slot rank component score anchor is_anchor u v links state entry".split()


@pytest.fixture(scope="module")
def rows():
    """Nulls, entries that are no numbers, zeros, copies, a dense group, short vectors, repeated rows, ids that repeat."""
    rng = np.random.default_rng(3)
    out = [
        (1, None, 1),
        (2, [None] + [0.5] * 7, 2),
        (3, [NAN] + [0.5] * 7, 3),
        (4, [INF] + [0.5] * 7, 4),
        (5, [0.0] * 8, 5),
        (6, [], 6),
        (None, [0.3] * 8, 1),
        (7, [0.25] * 4, None),
        (8, [0.25] * 4, 3),
        (9, [0.25] * 4 + [0.0] * 4, 3),
    ]
    for i in range(10, 260):
        out.append((i, (rng.normal(size=8) / 3).tolist(), int(rng.integers(0, 4))))
    centre = rng.normal(size=8)
    out += [(i, (centre + 0.05 * rng.normal(size=8)).tolist(), int(rng.integers(0, 2))) for i in range(260, 350)]
    copied = rng.normal(size=8).tolist()
    out += [(i, copied, i % 3) for i in range(350, 380)]
    out += [(400, copied, 2), out[20], out[20], (12, centre.tolist(), 3)]
    return out


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crowded(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def is_whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def matrix(found):
    return np.array([np.float32(list(v) + [0] * (8 - len(v))) for v in found], float)


# --- near duplicates ------------------------------------------------------------------------


def links_by_hand(rows, least):
    usable = [i is not None and is_whole(v) and any(v) for i, v, _ in rows]
    at = [k for k, ok in enumerate(usable) if ok]
    m = matrix([rows[k][1] for k in at])
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = m @ m.T >= least
    np.fill_diagonal(near, False)
    group = list(range(len(at)))

    def root(a):
        while group[a] != a:
            a = group[a]
        return a

    for a, b in np.argwhere(near):
        group[max(root(a), root(b))] = min(root(a), root(b))
    least_id = {}
    for a, k in enumerate(at):
        least_id[root(a)] = min(least_id.get(root(a), rows[k][0]), rows[k][0])
    out = [(i, 0, i) for (i, _, _), ok in zip(rows, usable, strict=True) if not ok]
    return Counter(out + [(rows[k][0], int(near[a].sum()), least_id[root(a)]) for a, k in enumerate(at)])


def as_counter(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_links_and_components(vectors, rows):
    got = nn_descent.near_duplicate_vectors(crowded(vectors), 0.9)
    assert as_counter(got, "vec_id", "n_links", "component_id") == links_by_hand(rows, 0.9)
    assert [r["recall"] for r in got.select("recall").distinct().collect()] == [1.0]


def test_wide_dense_groups_are_counted_exactly(spark):
    """Two dense groups whose angles do not decide all pairs, and one bridge, with lists that all overflow."""
    rng = np.random.default_rng(8)
    one = np.eye(8)[0] + 0.17 * rng.normal(size=(150, 8))
    two = np.eye(8)[0] * 0.85 + np.eye(8)[1] * 0.53 + 0.02 * rng.normal(size=(120, 8))
    some = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([one, two]))]
    got = nn_descent.near_duplicate_vectors(spark.createDataFrame(some, SCHEMA).repartition(3), 0.9)
    assert as_counter(got, "vec_id", "n_links", "component_id") == links_by_hand(some, 0.9)


def test_links_of_tables_without_vectors(spark, empty):
    assert nn_descent.near_duplicate_vectors(empty).count() == 0
    none = spark.createDataFrame([(1, None, 1), (None, [0.0], 1)], SCHEMA)
    assert as_counter(nn_descent.near_duplicate_vectors(none), "vec_id", "n_links", "component_id") == Counter([(1, 0, 1), (None, 0, None)])


def test_audit_sees_lost_links(vectors, rows):
    given = vectors.where("vec_id between 260 and 349").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    nodes = nn_descent.unit_nodes(given, 8)
    none = nodes.select("node", F.lit(0).cast("long").alias("links")).where("false")
    assert nn_descent.audit(none, nodes, 8, 0.9) == 0.0


# --- hard negatives -------------------------------------------------------------------------


def test_hilbert_curve_visits_neighbours():
    side = 8
    cells = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    key = hard_negatives.hilbert_keys(cells, 3)
    assert sorted(key) == list(range(side**3))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, m = rng.integers(-50, 50, (30, 6)).astype(float), rng.integers(-50, 50, (40, 6)).astype(float)
    low, high = hard_negatives.bounds(a, m.min(0)[None, :], m.max(0)[None, :])
    exact = a @ m.T
    assert (low[:, 0] <= exact.min(1)).all() and (high[:, 0] >= exact.max(1)).all()


def test_scores_past_doubles_are_exact():
    a = np.array([[2.0**31, 1.0, 3.0]])
    assert hard_negatives.scores(a, np.array([[2.0**31, 1.0, 0.0]])).tolist() == [[2**62 + 1]]


def negatives_by_hand(rows):
    part = [(i, int(label), np.floor(256 * m).astype(int)) for i, v, label in rows if i is not None and label is not None and is_whole(v) for m in matrix([v])]
    part = [(i, (label + 1) % 10 if i % 7 == 0 else label, x) for i, label, x in part]
    out = []
    for i, label, x in part:
        if i % 100:
            continue
        scored = sorted((-int(x @ y), j, other) for j, other, y in part)
        positives = [(-s, j) for s, j, other in scored if other == label and j != i][:5]
        for best, p in positives:
            window = [(-s, j) for s, j, other in scored if other != label and 30 * best <= -100 * s <= 90 * best][:10]
            out += [(i, p, r, j, best, s) for r, (s, j) in enumerate(window, 1)]
    return Counter(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def as_integers(df):
    keep = F.transform("embedding", lambda c: F.floor(c.cast("double") * 256))
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return df.where(hard_negatives.is_whole(F.col("embedding"))).withColumns({"label": changed, "x": keep})


def test_hard_negatives(vectors, rows, empty, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 2)
    monkeypatch.setattr(hard_negatives, "SHELF_ZONES", 3)
    crowd = vectors.withColumns({c: F.lit("y") for c in CLASHES if c != "x"})
    got = hard_negatives.hard_negatives(as_integers(crowd), F.col("vec_id") % 100 == 0)
    want = negatives_by_hand(rows)
    assert want and as_counter(got, *COLUMNS) == want
    assert hard_negatives.hard_negatives(as_integers(empty), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.hard_negatives(as_integers(vectors), F.lit(False)).count() == 0


def test_zone_maps_spare_blocks(spark):
    """On data with structure, an anchor's second step reads a part of the blocks."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (40, 4))
    some = [(i, (centres[i % 40] + rng.integers(-3, 4, 4)).tolist(), i % 2) for i in range(4000)]
    df = spark.createDataFrame(some, "id long, x array<long>, label long")
    placed = hard_negatives.with_place(df, 4, hard_negatives.curve_of(df, 4))
    table = hard_negatives.blocks(placed, 4, 50)
    shelf_table, n = hard_negatives.shelves(table, 4)
    assert table.agg(F.sum("n")).first()[0] == 4000 and n >= 1
    groups = hard_negatives.blocks(placed.where("id % 100 = 0"), 4, 1).select(F.col("block").alias("group"), "label", "x")
    best = spark.createDataFrame(
        [(r["group"], 0, 0, int((np.frombuffer(r["x"]) ** 2).sum() * 0.95), 1 << 40) for r in groups.collect()],
        "group long, anchor int, slot long, least long, most long",
    )
    asked = hard_negatives._with_wants(groups, best)
    chosen = hard_negatives.choose_blocks(asked, shelf_table, n, 4, True).count()
    assert chosen < 0.3 * groups.count() * table.count() / 2


# --- whitening ------------------------------------------------------------------------------


def test_rank_one_updates_and_merges():
    rng = np.random.default_rng(4)
    for width, n in ((12, 300), (5, 3), (1, 4), (6, 1)):
        m = np.floor(10 * rng.normal(size=(n, width)) * rng.random(width))
        m[n // 2 :] = m[: n - n // 2]
        parts = []
        for piece in np.array_split(m, 3):
            s = whitening.Spectrum.empty(width)
            for x in piece:
                s.add(x)
            parts.append(s)
        for other in parts[1:]:
            parts[0].merge(other)
        s, away = parts[0], m - m.mean(0)
        scatter = away.T @ away
        assert s.n == n and np.allclose(s.mean, m.mean(0))
        scale = max(1.0, np.abs(scatter).max())
        assert np.abs(s.vectors * s.values @ s.vectors.T - scatter).max() < 1e-12 * scale
        assert np.abs(s.vectors.T @ s.vectors - np.eye(width)).max() < 1e-12


def test_secular_roots_between_close_poles():
    d = np.array([0.0, 1e-12, 1.0, 1.0 + 1e-13, 5.0])
    base, mu = whitening.secular_roots(d, np.array([1e-3, 1.0, 1e-9, 0.5, 1e-7]), 2.0)
    roots = d[base] + mu
    assert (roots[:-1] <= d[1:]).all() and (roots >= d).all()


def whitened_by_hand(rows, most=16):
    kept = [(i, v) for i, v, _ in rows if is_whole(v)]
    x = np.floor(64 * matrix([v for _, v in kept])).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    away = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = ((n * x - sums) ** 2).sum(1)
    return kept, n, deviation, ((n * x - sums) / n) @ vectors[:, :most] / np.sqrt(values[:most]), values / values.sum()


def test_whitening(vectors, rows):
    got = whitening.whiten_embeddings(crowded(vectors)).collect()
    kept, n, deviation, projected, share = whitened_by_hand(rows)
    width = projected.shape[1]
    assert len(got) == len(kept) * width and {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got}.pop() < 1e-10
    assert all(abs(r["explained"] - share[r["component"] - 1]) < 1e-10 for r in got)
    by_hand, found = {}, {}
    for (i, _), d, p in zip(kept, deviation, projected, strict=True):
        by_hand.setdefault(i, []).append((d, *p))
    for r in got:
        found.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    signs = None
    for i, all_of in by_hand.items():
        for d, *p in all_of:
            mine = found[i, d]
            if len(mine[1]) == 1:
                values = np.array([mine[c + 1][0] for c in range(width)])
                signs = np.sign(values * p) if signs is None else signs
                assert np.abs(values - signs * p).max() < 1e-9


def test_whitening_of_small_tables(spark, empty):
    assert whitening.whiten_embeddings(empty).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, None, 0)], SCHEMA)
    assert whitening.whiten_embeddings(one).count() == 0
    flat = spark.createDataFrame([(1, [1.0, 2.0], 0), (None, [3.0, 2.0], 0)], SCHEMA)
    got = whitening.whiten_embeddings(flat).collect()
    assert sorted((r["component"], r["n"], abs(r["whitened"]), r["explained"]) for r in got) == [(1, 2, 1.0, 1.0)] * 2


def test_deviations_that_do_not_fit_are_null():
    w = whitening.Whitening(10**9, 0, [0, 0], np.zeros(0), np.zeros((2, 0)), 0.0)
    assert whitening._deviations(np.array([[1, 1], [100, 0]]), w) == [2 * 10**18, None]


def test_vector_queries(spark, sf_dir):
    links = queries.op11_embedding_dedup(spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert links.columns[:3] == ["vec_id", "n_links", "component_id"] and links.count() == n
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    wide = [(i, np.floor(256 * np.array(v, float)).astype(int), (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in table]
    want = Counter()
    for i, x, label in wide:
        if i % 100 == 0:
            scored = sorted((-int(x @ y), j, other) for j, y, other in wide)
            for s, p, _ in [t for t in scored if t[2] == label and t[1] != i][:5]:
                window = [(t, j) for t, j, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s][:10]
                want += Counter((i, p, r, j, -s, -t) for r, (t, j) in enumerate(window, 1))
    assert as_counter(queries.op12_hard_negatives(spark, sf_dir), *COLUMNS) == want
    white = queries.op13_whitening(spark, sf_dir)
    assert white.count() == 16 * n and white.first()["identity_error"] < 1e-4
