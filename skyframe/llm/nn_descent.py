"""Near-duplicate vectors by NN-descent.

A graph of the nearest neighbours found so far starts from blocks along random projections and
is refined: neighbours of neighbours are compared, in single precision, until hardly an edge
changes. A vector whose whole list passes the threshold may have more links than its list has
places, so the list is doubled and the refinement goes on. Vectors that fill even the longest
list lie in dense groups; these are finished exactly, by angles to the group's centre and, where
angles don't decide, in blocks of vectors that give counts and never pairs. Edges kept for the
answer are confirmed in double precision, and the recall is measured against all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import materialise
from skyframe.llm.components import connected_components
from skyframe.llm.vectors import as_matrix, column_of, is_whole, longest, padded, runs
from skyframe.session import discard

#: First and longest length of a neighbour list, reverse neighbours that join them, random trees.
FIRST, LONGEST, REVERSE, TREES = 8, 32, 8, 4
#: Vectors compared in one block of a tree; sign bits of a tree's order.
LEAF, BITS = 128, 24
#: Refinement ends below this share of changed edges, and after so many rounds.
CHANGED, ROUNDS = 0.002, 20
#: Vectors of the audit, the recall it asks for, and how often more trees are grown to reach it.
AUDITED, RECALL, TRIES = 1000, 0.98, 3
#: Rows of a block where vectors of dense groups are compared.
BLOCK = 512
#: Single precision is trusted to this much, angles to this much.
LOOSE, MARGIN = 1e-4, 1e-6


def _units(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _rows(blobs: pa.Array, length: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), kind).reshape(-1, length)


def unit_nodes(given: DataFrame, length: int) -> DataFrame:
    """Each distinct vector of ``id, vec`` once: ``node, weight, least, vec, unit`` (doubles) and ``small`` (floats)."""
    distinct = given.groupBy("vec").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
    numbered = materialise(distinct, "distinct").withColumn("node", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _units(as_matrix(column_of(b, "vec"), length))
            kept = [column_of(b, n) for n in ("node", "weight", "least", "vec")]
            unit, small = [x.tobytes() for x in m], [x.tobytes() for x in m.astype("<f4")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(unit, pa.binary()), pa.array(small, pa.binary())], ["node", "weight", "least", "vec", "unit", "small"]
            )

    of = dict(given.dtypes)["id"]
    return materialise(
        numbered.select("node", "weight", "least", "vec").mapInArrow(
            run, f"node long, weight long, least {of}, vec array<double>, unit binary, small binary"
        ),
        "nodes",
    )


# --- the graph ------------------------------------------------------------------------------


def _mean(nodes: DataFrame, length: int) -> np.ndarray:
    """The mean unit vector: one row per entry reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _rows(column_of(b, "small"), length, "<f4").astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(np.full(length, len(m))), pa.array(m.sum(0))], ["entry", "n", "a"])

    found = nodes.select("small").mapInArrow(run, "entry long, n long, a double").groupBy("entry").agg((F.sum("a") / F.sum("n")).alias("m"))
    mean = np.zeros(length)
    for r in found.collect():
        mean[r["entry"]] = r["m"]
    return mean


def _best(u: np.ndarray, v: np.ndarray, sim: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the first ``size`` distinct neighbours of each ``u`` by falling similarity."""
    order = np.lexsort((v, -sim, u))
    if not len(order):
        return order
    # Equal pairs may differ in the last bit, so repeats are found by number.
    by_pair = np.lexsort((-sim, v, u))
    first = np.ones(len(order), bool)
    first[1:] = (u[by_pair[1:]] != u[by_pair[:-1]]) | (v[by_pair[1:]] != v[by_pair[:-1]])
    single = np.zeros(len(order), bool)
    single[by_pair[first]] = True
    order = order[single[order]]
    start = np.concatenate([[True], u[order[1:]] != u[order[:-1]]])
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    return order[rank < size[order]]


_EDGES = "u long, size int, v long, sim float, fresh boolean"


def _edges(u, size, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), pa.array(size, pa.int32()), pa.array(v, pa.int64()), pa.array(sim, pa.float32()), pa.array(np.ones(len(u), bool))],
        ["u", "size", "v", "sim", "fresh"],
    )


def tree_edges(nodes: DataFrame, length: int, least: float, seeds: list[int]) -> DataFrame:
    """The nearest ``FIRST`` of each vector among those beside it, in the order of each random tree."""
    mean = _mean(nodes, length)
    planes = [np.random.default_rng(s).normal(size=(length, BITS)) for s in seeds]
    powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _rows(column_of(b, "small"), length, "<f4") - mean
            for tree, plane in enumerate(planes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(m), pa.int32()), pa.array((m @ plane > 0) @ powers), column_of(b, "node"), column_of(b, "small")],
                    ["tree", "code", "node", "small"],
                )

    keys = ["tree", "code", "node"]
    coded = nodes.select("node", "small").mapInArrow(codes, "tree int, code long, node long, small binary")
    ordered = coded.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tree, node = column_of(b, "tree").to_numpy(), column_of(b, "node").to_numpy()
            m = _rows(column_of(b, "small"), length, "<f4")
            for start, end in runs(tree):
                leaves = max(1, (end - start) // LEAF)
                for part in np.array_split(np.arange(start, end), leaves):
                    sim = m[part] @ m[part].T
                    np.fill_diagonal(sim, -2)
                    k = min(FIRST, len(part) - 1)
                    near = np.argpartition(-sim, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(part), 0), int)
                    u, v = np.repeat(node[part], k), node[part][near].ravel()
                    yield _edges(u, np.full(len(u), FIRST), v, np.take_along_axis(sim, near, 1).ravel())

    return _merged(ordered.select("tree", "node", "small").mapInArrow(compare, _EDGES), least)


def _merged(edges: DataFrame, least: float) -> DataFrame:
    """Lists cut to their sizes, of edges that may repeat; an edge that was there before is not fresh.

    A saturated list is doubled, and all its edges are fresh again.
    """
    once = edges.groupBy("u", "v").agg(F.max("size").alias("size"), F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    nearest = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    ranked = once.withColumn("_rank", F.row_number().over(nearest)).where((F.col("_rank") <= F.col("size")) & (F.col("_rank") <= LONGEST))
    own = Window.partitionBy("u")
    full = (F.max("_rank").over(own) >= F.col("size")) & (F.min("sim").over(own) >= least - LOOSE) & (F.col("size") < LONGEST)
    grown = ranked.withColumn("_full", full)
    return grown.select(
        "u",
        F.when(F.col("_full"), F.least(F.col("size") * 2, F.lit(LONGEST))).otherwise(F.col("size")).alias("size"),
        "v",
        "sim",
        (F.col("fresh") | F.col("_full")).alias("fresh"),
    )


def _lists(graph: DataFrame) -> DataFrame:
    """``owner, member, fresh``: neighbours and the nearest reverse neighbours of each vector that has a fresh one."""
    nearest = Window.partitionBy("v").orderBy(F.desc("fresh"), F.desc("sim"), "u")
    back = graph.withColumn("_rank", F.row_number().over(nearest)).where(F.col("_rank") <= REVERSE)
    both = graph.select(F.col("u").alias("owner"), F.col("v").alias("member"), "fresh").unionByName(
        back.select(F.col("v").alias("owner"), F.col("u").alias("member"), "fresh")
    )
    every = both.groupBy("owner", "member").agg(F.max("fresh").alias("fresh"))
    news = F.max("fresh").over(Window.partitionBy("owner"))
    return every.withColumn("_any", news).where("_any").drop("_any")


def _local_join(members: DataFrame, length: int) -> DataFrame:
    """All pairs of members of an owner with a fresh one among them that would enter a list."""

    def pairs(node, fresh, bar, size, m, edges) -> Iterator[tuple]:
        counts = np.diff(edges)
        for n in np.unique(counts):
            at = edges[:-1][counts == n]
            for some in np.array_split(at, max(1, len(at) * n * length // (1 << 21))):
                rows = some[:, None] + np.arange(n)
                block = m[rows]
                sim = block @ block.transpose(0, 2, 1)
                sim[:, np.arange(n), np.arange(n)] = -2
                new = fresh[rows]
                good = (sim > bar[rows][:, :, None]) & (new[:, :, None] | new[:, None, :])
                g, i, j = np.nonzero(good)
                yield node[rows[g, i]], size[rows[g, i]], node[rows[g, j]], sim[g, i, j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            get = lambda name: table[name].to_numpy()
            owner = get("owner")
            edges = np.array([0, *(end for _, end in runs(owner))])
            m = _rows(table["small"], length, "<f4")
            found = list(pairs(get("member"), get("fresh"), get("bar"), get("size"), m, edges))
            if found:
                u, size, v, sim = (np.concatenate(x) for x in zip(*found, strict=True))
                keep = _best(u, v, sim, size)
                yield _edges(u[keep], size[keep], v[keep], sim[keep])

        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            owner = held["owner"].to_numpy()
            whole = int(np.searchsorted(owner, owner[-1])) if len(owner) else 0
            if whole and held.num_rows > 20_000:
                yield from flush(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from flush(held)

    return members.repartition("owner").sortWithinPartitions("owner").mapInArrow(run, _EDGES)


def _round(graph: DataFrame, nodes: DataFrame, length: int, least: float) -> DataFrame:
    each = graph.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("worst"), F.max("size").alias("size"))
    # A place beyond the first list is only for what passes the threshold.
    bar = F.when(F.col("n") < F.col("size"), F.lit(-1.5)).otherwise(F.col("worst"))
    bar = F.when((F.col("size") > FIRST) & (F.col("n") >= FIRST), F.greatest(bar, F.lit(least - LOOSE))).otherwise(bar)
    known = nodes.join(each, nodes["node"] == each["u"], "left").select(
        F.col("node").alias("member"), "small", F.coalesce(bar, F.lit(-1.5)).cast("float").alias("bar"), F.coalesce("size", F.lit(FIRST)).alias("size")
    )
    candidates = _local_join(_lists(graph).join(known, "member"), length)
    return _merged(graph.withColumn("fresh", F.lit(False)).unionByName(candidates), least)


def descend(graph: DataFrame, nodes: DataFrame, length: int, least: float) -> DataFrame:
    """Refine a written graph until hardly an edge changes, neither in first lists nor in longer ones."""
    for _ in range(ROUNDS):
        graph = _replaced(graph, _round(graph, nodes, length, least), "graph")
        longer = (F.col("size") > FIRST).alias("longer")
        changed = graph.groupBy(longer).agg(F.count_if("fresh").alias("fresh"), F.count("*").alias("n")).collect()
        if all(r["fresh"] <= CHANGED * r["n"] for r in changed):
            break
    return graph


def _replaced(old: DataFrame, new: DataFrame, label: str) -> DataFrame:
    out = materialise(new, label)
    discard(old)
    return out


# --- links ----------------------------------------------------------------------------------


def confirmed(graph: DataFrame, nodes: DataFrame, length: int, least: float) -> DataFrame:
    """``u, v`` (u < v) for each edge whose cosine in double precision is at least ``least``."""
    near = graph.where(F.col("sim") >= least - LOOSE).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    one = nodes.select(F.col("node").alias("u"), F.col("unit").alias("a"))
    two = nodes.select(F.col("node").alias("v"), F.col("unit").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cos = (_rows(column_of(b, "a"), length, "<f8") * _rows(column_of(b, "b"), length, "<f8")).sum(1)
            yield b.select(["u", "v"]).filter(pa.array(cos >= least))

    return near.join(one, "u").join(two, "v").mapInArrow(run, "u long, v long")


def _centres(members: DataFrame, length: int) -> DataFrame:
    """``cell, centre`` (array): the direction of the sum of the members, added inside each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            m, cell = _rows(column_of(b, "unit"), length, "<f8"), column_of(b, "cell").to_numpy()
            order = np.argsort(cell, kind="stable")
            for start, end in runs(cell[order]):
                key = int(cell[order[start]])
                sums[key] = sums.get(key, 0) + m[order[start:end]].sum(0)
        keys = np.fromiter(sums, np.int64, len(sums))
        total = np.concatenate([np.zeros(0), *sums.values()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(keys, length)), pa.array(np.tile(np.arange(length), len(keys))), pa.array(total)], ["cell", "entry", "a"]
        )

    sums = members.select("cell", "unit").mapInArrow(run, "cell long, entry long, a double").groupBy("cell", "entry").agg(F.sum("a").alias("a"))
    whole = sums.groupBy("cell").agg(F.transform(F.array_sort(F.collect_list(F.struct("entry", "a"))), lambda x: x["a"]).alias("sum"))
    size = F.sqrt(F.aggregate("sum", F.lit(0.0), lambda s, x: s + x * x))
    return whole.select("cell", F.transform("sum", lambda x: x / F.greatest(size, F.lit(1e-300))).alias("centre"))


def _with_angle(members: DataFrame, length: int) -> DataFrame:
    """``node, weight, cell, unit, angle`` to the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cos = (_rows(column_of(b, "unit"), length, "<f8") * as_matrix(column_of(b, "centre"), length)).sum(1)
            angle = np.arccos(np.clip(cos, -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*[column_of(b, n) for n in ("node", "weight", "cell", "unit")], pa.array(angle)], ["node", "weight", "cell", "unit", "angle"]
            )

    return members.join(_centres(members, length), "cell").mapInArrow(run, "node long, weight long, cell long, unit binary, angle double")


def cell_pairs(cells: DataFrame, length: int, least: float) -> DataFrame:
    """``a, b, certain`` (a <= b) of cells ``cell, centre, radius`` that can hold a link: all do, or some may.

    Blocks of cells against blocks of cells; a cell has more than ``LONGEST`` vectors.
    """
    theta = float(np.arccos(least))
    shelves = max(1, -(-cells.count() // 256))
    shelf = F.pmod(F.xxhash64("cell"), F.lit(shelves))
    packed = cells.groupBy(shelf.alias("shelf")).agg(F.collect_list(F.struct("cell", "centre", "radius")).alias("cells"))
    packed = materialise(packed, "cell-shelves")
    others = packed.select(F.col("shelf").alias("other"), F.col("cells").alias("b"))
    beside = packed.select(F.col("cells").alias("a"), F.explode(F.sequence("shelf", F.lit(shelves - 1).cast("long"))).alias("other"))

    def parts(x: list) -> tuple[np.ndarray, ...]:
        return np.array([c["cell"] for c in x]), np.array([c["centre"] for c in x]), np.array([c["radius"] for c in x])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                (a, ca, ra), (b, cb, rb) = parts(r["a"]), parts(r["b"])
                angle = np.arccos(np.clip(ca @ cb.T, -1, 1))
                angle[a[:, None] == b[None, :]] = 0
                radii = ra[:, None] + rb[None, :]
                i, j = np.nonzero(angle - radii <= theta + MARGIN)
                certain = (angle + radii <= theta - MARGIN)[i, j]
                low, high = np.minimum(a[i], b[j]), np.maximum(a[i], b[j])
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(certain)], ["a", "b", "certain"])

    return beside.join(others, "other").mapInArrow(run, "a long, b long, certain boolean").distinct()


def _compared(members: DataFrame, pairs: DataFrame, length: int, least: float) -> DataFrame:
    """``node, links, other``: weight of linked vectors of undecided cell pairs, and the least linked one, per block pair."""
    blocks = members.groupBy("cell", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")).agg(
        F.collect_list(F.struct("node", "weight", "unit")).alias("rows")
    )
    blocks = materialise(blocks, "cell-blocks")
    one = blocks.select(F.col("cell").alias("a"), F.col("part").alias("p"), F.col("rows").alias("one"))
    two = blocks.select(F.col("cell").alias("b"), F.col("part").alias("q"), F.col("rows").alias("two"))

    def parts(x: list) -> tuple[np.ndarray, ...]:
        return np.array([r["node"] for r in x]), np.array([r["weight"] for r in x]), np.frombuffer(b"".join(r["unit"] for r in x)).reshape(-1, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                (a, wa, ma), (b, wb, mb) = parts(r["one"]), parts(r["two"])
                near = (ma @ mb.T >= least) & (a[:, None] != b[None, :])
                sides = [(a, near, wb, b)] if r["a"] == r["b"] else [(a, near, wb, b), (b, near.T, wa, a)]
                for node, linked, weight, other in sides:
                    some = linked.any(1)
                    least_one = np.where(linked[some], other[None, :], np.iinfo(np.int64).max).min(1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[some]), pa.array((linked[some] * weight).sum(1)), pa.array(least_one)], ["node", "links", "other"]
                    )

    # Of one cell with itself, every ordered pair of blocks is met, and each gives its first side.
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "node long, links long, other long")


def _dense(graph: DataFrame, links: DataFrame, nodes: DataFrame, length: int, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links among vectors whose longest list is saturated and what is linked with these, all counted exactly.

    These nodes, ``node, links``, and edges that join what is linked. A vector just beside a full
    list may lack some links of its own, so it is finished with them.
    """
    each = graph.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("worst"))
    full = each.where((F.col("n") >= LONGEST) & (F.col("worst") >= least - LOOSE)).select("u")
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    beside = both.join(full, "u", "left_semi").select(F.col("v").alias("node"))
    dense = materialise(full.select(F.col("u").alias("node")).unionByName(beside).distinct(), "dense")
    inner = links.join(dense.withColumnRenamed("node", "u"), "u", "left_semi").join(dense.withColumnRenamed("node", "v"), "v", "left_semi")
    cells = connected_components(inner).withColumnRenamed("component", "cell")
    # One whose list holds no other dense vector is a cell of its own.
    cells = dense.join(cells, "node", "left").select("node", F.coalesce("cell", "node").alias("cell"))
    members = nodes.select("node", "weight", "unit").join(cells, "node")
    members = materialise(_with_angle(members, length), "cell-members")
    sums = members.groupBy("cell").agg(F.max("angle").alias("radius"), F.sum("weight").alias("total"), F.count("*").alias("n"))
    sums = materialise(sums.join(_centres(members, length), "cell"), "cells")
    pairs = materialise(cell_pairs(sums.select("cell", "centre", "radius"), length, least), "cell-pairs")
    sure = pairs.where("certain")
    both = sure.unionByName(sure.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "certain"))
    totals = sums.select(F.col("cell").alias("b"), "total")
    whole = both.join(totals, "b").groupBy(F.col("a").alias("cell")).agg(
        F.sum("total").alias("whole"), F.max(F.col("a") == F.col("b")).alias("own")
    )
    by_cell = members.select("node", "weight", "cell").join(whole, "cell").select(
        "node", (F.col("whole") - F.when(F.col("own"), F.col("weight")).otherwise(0)).alias("links")
    )
    open_pairs = pairs.where("NOT certain").select("a", "b")
    open_cells = open_pairs.select(F.col("a").alias("cell")).unionByName(open_pairs.select(F.col("b").alias("cell"))).distinct()
    split = sums.join(open_cells, "cell", "left_semi").select("cell", F.ceil(F.col("n") / BLOCK).alias("parts"))
    compared = materialise(_compared(members.join(split, "cell"), open_pairs, length, least), "compared")
    counts = by_cell.unionByName(compared.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    joins = sure.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        compared.select(F.col("node").alias("u"), F.col("other").alias("v"))
    )
    return dense, counts, joins


def count_links(graph: DataFrame, nodes: DataFrame, length: int, least: float) -> tuple[DataFrame, DataFrame]:
    """``node, links`` (weight of other vectors with a link) and ``u, v``, edges with the same components as all links."""
    links = materialise(confirmed(graph, nodes, length, least), "links")
    dense, inside, joins = _dense(graph, links, nodes, length, least)
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    marked = dense.select("node", F.lit(True).alias("_dense"))
    one, two = marked.withColumnsRenamed({"node": "u", "_dense": "_u"}), marked.withColumnsRenamed({"node": "v", "_dense": "_v"})
    outside = both.join(one, "u", "left").join(two, "v", "left").where(~(F.col("_u").isNotNull() & F.col("_v").isNotNull()))
    weights = nodes.select(F.col("node").alias("v"), "weight")
    counts = outside.join(weights, "v").select(F.col("u").alias("node"), F.col("weight").alias("links"))
    total = counts.unionByName(inside).groupBy("node").agg(F.sum("links").alias("links"))
    return materialise(total, "counts"), links.unionByName(joins)


def audit(counts: DataFrame, nodes: DataFrame, length: int, least: float) -> float:
    """Share of the links of ``AUDITED`` vectors (all, if fewer), found by comparing these with all, that the counts hold."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(AUDITED).select("node", "unit").collect()
    if not sample:
        return 1.0
    m = np.frombuffer(b"".join(bytes(r["unit"]) for r in sample)).reshape(-1, length)
    names = np.array([r["node"] for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for b in batches:
            node, weight = column_of(b, "node").to_numpy(), column_of(b, "weight").to_numpy()
            near = (m @ _rows(column_of(b, "unit"), length, "<f8").T >= least) & (names[:, None] != node[None, :])
            total += (near * weight).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total)], ["node", "true"])

    true = nodes.select("node", "weight", "unit").mapInArrow(run, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    got = true.join(counts, "node", "left").agg(F.sum("true").alias("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0)))).alias("got")).first()
    return got["got"] / got["true"] if got["true"] else 1.0


def near_duplicate_vectors(rows: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, n_links, component_id, recall`` for every row: links are cosines of at least ``least``.

    ``n_links`` counts the other rows that a row is linked with; the component is named by its
    smallest id. Rows with a null id or vector, a null or infinite entry or NaN, or only zeros link
    with nothing and are a component of their own. Shorter vectors count as filled up with zeros.
    Equal vectors are compared once and counted by their number, so copies and repeated rows are
    linked with each other; rows of one id but different vectors are tied only by their cosine.
    ``recall`` is what the audit measured, the same value in every row. An empty table gives no
    rows. Other columns are ignored.
    """
    kept = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec"))
    usable = F.coalesce(is_whole(F.col("vec")) & F.exists("vec", lambda x: x != 0) & F.col("id").isNotNull(), F.lit(False))
    length = longest(kept.where(usable), "vec")
    as_double = padded(F.transform("vec", lambda x: x.cast("double")), length, F.lit(0.0))
    given = kept.where(usable).select("id", as_double.alias("vec"))
    nodes = unit_nodes(given, length)
    n, graph, recall = nodes.count(), None, 1.0
    if n:
        for attempt in range(TRIES):
            trees = tree_edges(nodes, length, least, [attempt * TREES + i for i in range(TREES)])
            if graph is None:
                graph = materialise(trees, "graph")
            else:
                graph = _replaced(graph, _merged(graph.unionByName(trees), least), "graph")
            graph = descend(graph, nodes, length, least)
            counts, edges = count_links(graph, nodes, length, least)
            recall = audit(counts, nodes, length, least)
            if recall >= RECALL:
                break
        components = connected_components(edges)
        known = nodes.join(counts, "node", "left").join(components, "node", "left")
        known = known.select("vec", "least", "weight", "links", F.coalesce("component", "node").alias("component"))
        known = materialise(known, "known")
        names = known.groupBy("component").agg(F.min("least").alias("component_id"))
        of_vector = known.join(names, "component").select(
            "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
        )
        found = given.join(of_vector, "vec").select("id", "n_links", "component_id")
        alone = kept.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
        out = found.unionByName(alone)
    else:
        out = kept.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.lit(recall).alias("recall"))
