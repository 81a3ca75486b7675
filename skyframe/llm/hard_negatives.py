"""Hard negatives from Hilbert-ordered blocks of candidates with zone maps.

Candidates are sorted by label and place on a Hilbert curve and written as blocks of one label,
with the least and greatest value of every dimension. From these alone, interval arithmetic
bounds the score of any row of a block with an anchor. An anchor first reads the blocks of
highest bound, and then only those that can still hold something better, inside its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import batch_of, materialise, schema_of
from skyframe.llm.vectors import as_matrix, column_of, is_whole, longest, padded, runs
from skyframe.session import discard

#: Rows of a block of candidates, anchors of a block of anchors, zones of a shelf.
BLOCK_ROWS, ANCHOR_ROWS, SHELF_ZONES = 512, 128, 256
#: Dimensions of the Hilbert curve and bits of each.
CURVE_DIMS, CURVE_BITS = 12, 5
#: Blocks that an anchor reads before its bounds are known.
SEEDS = 2


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of non-negative integers under ``2**bits`` on the Hilbert curve.

    The coordinates are rotated and reflected from the highest bit down, turned into a Gray code,
    and their bits interleaved; bits times dimensions must be at most 63.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    if dims * bits > 63:
        raise ValueError("a place must fit 63 bits")
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(dims):
            up = (x[i] >> bit & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[-1])
    for bit in range(bits - 1, 0, -1):
        turn = np.where(x[-1] >> bit & 1, turn ^ ((1 << bit) - 1), turn)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | ((x[i] ^ turn) >> bit & 1)
    return key


def curve_of(rows: DataFrame, length: int) -> list[tuple[int, float, float]]:
    """Dimensions of greatest spread, each with its lower end and width: ``length`` sums reach the driver."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = as_matrix(column_of(b, "x"), length)
            columns = [np.arange(length), np.full(length, len(m)), m.sum(0), (m * m).sum(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["entry", "n", "a", "b"])

    found = rows.select("x").mapInArrow(moments, "entry long, n long, a double, b double")
    sums = found.groupBy("entry").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    spread = [(r["entry"], r["a"] / r["n"], max(0.0, r["b"] / r["n"] - (r["a"] / r["n"]) ** 2) ** 0.5) for r in sums]
    spread.sort(key=lambda x: (-x[2], x[0]))
    return [(i, mean - 2 * sd, 4 * sd or 1.0) for i, mean, sd in spread[:CURVE_DIMS]]


def with_place(rows: DataFrame, length: int, curve: list[tuple[int, float, float]]) -> DataFrame:
    """Add ``place``, the position on the curve."""
    dims, low, width = [c[0] for c in curve], np.array([c[1] for c in curve]), np.array([c[2] for c in curve])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = as_matrix(column_of(b, "x"), length)[:, dims]
            cells = np.clip((m - low) / width * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            yield batch_of(b, names, place=pa.array(hilbert_keys(cells, CURVE_BITS)))

    return rows.mapInArrow(run, schema_of(rows, ("place", T.LongType())))


def blocks(rows: DataFrame, length: int, size: int, more: list[str] | None = None) -> DataFrame:
    """Rows ``id, label, x, place`` as a written table of blocks of at most ``size`` rows of one label.

    ``block, label, n, ids, x`` (a matrix of doubles; see ``narrow``), ``low`` and ``high``: the
    zone map. Equal rows are told apart by where they were read, so that a range never outgrows a task.
    """
    more = more or []
    ordered = rows.withColumn("_at", F.monotonically_increasing_id())
    keys = ["label", "place", "id", "_at"]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = T.StructType(
        [
            *[T.StructField(n, T.LongType()) for n in ("block", "label", "n")],
            *[T.StructField(n, T.BinaryType()) for n in ("ids", "x", "low", "high")],
            *[T.StructField(n, T.BinaryType()) for n in more],
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush(parts: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            ids, m = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
            order = np.argsort(ids, kind="stable")
            ids, m = ids[order], m[order]
            extra = [np.concatenate([p[3][k] for p in parts])[order].tobytes() for k in range(len(more))]
            values = [number, parts[0][0], len(ids), ids.tobytes(), m.tobytes(), m.min(0).tobytes(), m.max(0).tobytes(), *extra]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], schema.names)

        for b in batches:
            label, ids = column_of(b, "label").to_numpy(), column_of(b, "id").to_numpy()
            m = as_matrix(column_of(b, "x"), length)
            extra = [as_matrix(column_of(b, c), 1, np.int64) for c in more]
            for start, end in runs(label):
                while start < end:
                    if held and (held[0][0] != label[start] or sum(len(p[1]) for p in held) >= size):
                        yield flush(held)
                        held = []
                    stop = min(end, start + size - sum(len(p[1]) for p in held))
                    held.append((int(label[start]), ids[start:stop], m[start:stop], [e[start:stop] for e in extra]))
                    start = stop
        if held:
            yield flush(held)

    return materialise(ordered.select("id", "label", "x", *more).mapInArrow(cut, schema), "blocks")


def shelves(table: DataFrame, length: int) -> tuple[DataFrame, int]:
    """The zone map of the blocks without their rows, ``SHELF_ZONES`` to a row, and the number of such rows."""
    zones = table.select("block", "label", "n", "low", "high").orderBy("block")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            for at in range(0, whole.num_rows, SHELF_ZONES):
                part = whole.slice(at, SHELF_ZONES).to_pydict()
                blobs = [np.array(part[c], np.int64).tobytes() for c in ("block", "label", "n")]
                blobs += [b"".join(part[c]) for c in ("low", "high")]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in blobs], ["blocks", "labels", "sizes", "lows", "highs"])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= SHELF_ZONES:
                yield from flush()
                held = []
        if held:
            yield from flush()

    kinds = "blocks binary, labels binary, sizes binary, lows binary, highs binary"
    made = materialise(zones.mapInArrow(bundle, kinds).withColumn("_at", F.monotonically_increasing_id()), "shelves")
    # The number of a shelf among all: one count per task reaches the driver.
    per_task = F.shiftright("_at", 33)
    counts = sorted((r["task"], r["n"]) for r in made.groupBy(per_task.alias("task")).agg(F.count("*").alias("n")).collect())
    before, total = {}, 0
    for task, n in counts:
        before[task], total = total, total + n
    first = F.create_map(*[F.lit(v).cast("long") for pair in before.items() for v in pair]) if before else None
    number = F.element_at(first, per_task) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) if before else F.lit(0).cast("long")
    return made.withColumn("shelf", number).drop("_at"), total


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any point of each box.

    Widened by what rounding can lose, so that a bound is never passed.
    """
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    room = 1e-12 * (np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T)
    return up @ low.T + down @ high.T - room, up @ high.T + down @ low.T + room


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products. Doubles hold every sum where the bound below says so; else Python's integers do."""
    reach = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if reach < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in b]
    exact = [[sum(int(x) * y for x, y in zip(row, other, strict=True)) for other in whole] for row in a]
    return np.array(exact, np.int64).reshape(len(a), len(b))


def _matrix(blob: bytes, length: int) -> np.ndarray:
    return np.frombuffer(blob).reshape(-1, length)


class Ranked:
    """Which rows of one block an anchor wants, highest score first, ties by the smaller id."""

    def __init__(self, ids: np.ndarray, score: np.ndarray):
        # Ids rise inside a block, so a stable sort by falling score orders ties.
        order = np.argsort(-score, axis=1, kind="stable")
        self.ids, self.falling = ids[order], -np.take_along_axis(score, order, 1)

    def window(self, i: int, least: int, most: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.falling[i]
        start, end = np.searchsorted(at, -most, "left"), np.searchsorted(at, -least, "right")
        end = min(end, start + k)
        return self.ids[i, start:end], -at[start:end]


#: A want is one row of scores that an anchor asks for: its number, and least and greatest score.
WANT = np.dtype([("anchor", "<i4"), ("slot", "<i8"), ("least", "<i8"), ("most", "<i8")])
ANY = (-(1 << 62), 1 << 62)


def choose_seeds(anchors: DataFrame, shelf_table: DataFrame, n_shelves: int, length: int, same: bool, k: int) -> DataFrame:
    """``group, block`` of the blocks each anchor reads first: those of highest upper bound, of its label or of others.

    Only anchors with a want are asked for. ``SEEDS`` blocks per anchor come out of each shelf,
    and of these again ``SEEDS``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                wants = np.frombuffer(r["wants"], WANT)
                mine = np.unique(wants["anchor"])
                blocks_ = np.frombuffer(r["blocks"], np.int64)
                labels = np.frombuffer(r["labels"], np.int64)
                of = np.flatnonzero((labels == r["label"]) == same)
                if not len(of) or not len(mine):
                    continue
                _, high = bounds(_matrix(r["x"], length)[mine], _matrix(r["lows"], length)[of], _matrix(r["highs"], length)[of])
                best = np.argsort(-high, axis=1, kind="stable")[:, :SEEDS]
                for i, a in enumerate(mine):
                    out += [(r["group"], int(a), int(blocks_[of[j]]), float(high[i, j])) for j in best[i]]
            yield pa.RecordBatch.from_pylist([dict(zip(("group", "anchor", "block", "bound"), x, strict=True)) for x in out], schema=arrow)

    arrow = pa.schema([("group", pa.int64()), ("anchor", pa.int32()), ("block", pa.int64()), ("bound", pa.float64())])
    pairs = _beside(anchors, shelf_table, n_shelves)
    found = pairs.mapInArrow(run, "group long, anchor int, block long, bound double")
    best = Window.partitionBy("group", "anchor").orderBy(F.desc("bound"), "block")
    return found.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= SEEDS).select("group", "block").distinct()


def choose_blocks(anchors: DataFrame, shelf_table: DataFrame, n_shelves: int, length: int, same: bool) -> DataFrame:
    """``group, block`` wherever the bounds of a block meet the window of any want of the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            groups, found = [], []
            for r in b.to_pylist():
                wants = np.frombuffer(r["wants"], WANT)
                of = np.flatnonzero((np.frombuffer(r["labels"], np.int64) == r["label"]) == same)
                if not len(of) or not len(wants):
                    continue
                low, high = bounds(_matrix(r["x"], length), _matrix(r["lows"], length)[of], _matrix(r["highs"], length)[of])
                meets = (high[wants["anchor"]] >= wants["least"][:, None]) & (low[wants["anchor"]] <= wants["most"][:, None])
                chosen = np.frombuffer(r["blocks"], np.int64)[of[meets.any(0)]]
                groups += [r["group"]] * len(chosen)
                found += chosen.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(found, pa.int64())], ["group", "block"])

    return _beside(anchors, shelf_table, n_shelves).mapInArrow(run, "group long, block long")


def _beside(anchors: DataFrame, shelf_table: DataFrame, n_shelves: int) -> DataFrame:
    """Each block of anchors beside each shelf of zones: the stated queries against all zones, in blocks."""
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shelves - 1).cast("long")))
    return anchors.select("group", "label", "x", "wants", every.alias("shelf")).join(shelf_table, "shelf")


def read_blocks(chosen: DataFrame, anchors: DataFrame, table: DataFrame, length: int, same: bool, k: int) -> DataFrame:
    """``slot, id, score``: at most ``k`` rows per want from each task that met it, the best of what the chosen blocks hold.

    The anchor itself is never returned, nor a row of the wrong kind of label.
    """
    columns = ["slot", "id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> pa.RecordBatch:
            sizes = [len(v[0]) for v in best.values()]
            slot = np.repeat(np.fromiter(best, np.int64, len(best)), sizes)
            ids = np.concatenate([np.zeros(0, np.int64), *[v[0] for v in best.values()]])
            score = np.concatenate([np.zeros(0, np.int64), *[v[1] for v in best.values()]])
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(ids), pa.array(score)], columns)

        for b in batches:
            for r in b.to_pylist():
                wants, own = np.frombuffer(r["wants"], WANT), np.frombuffer(r["own"], np.int64)
                ids, m = np.frombuffer(r["ids"], np.int64), _matrix(r["x"], length)
                a = _matrix(r["ax"], length)
                of = np.unique(wants["anchor"])
                ranked = Ranked(ids, scores(a[of], m))
                for w, i in zip(wants, np.searchsorted(of, wants["anchor"]), strict=True):
                    # Rows with the anchor's own id are taken out again.
                    selves = int((ids == own[w["anchor"]]).sum()) if same else 0
                    new, score = ranked.window(i, int(w["least"]), int(w["most"]), k + selves)
                    if same:
                        other = new != own[w["anchor"]]
                        new, score = new[other][:k], score[other][:k]
                    if not len(new):
                        continue
                    if (slot := int(w["slot"])) in best:
                        new, score = np.concatenate([best[slot][0], new]), np.concatenate([best[slot][1], score])
                        order = np.lexsort((new, -score))[:k]
                        new, score = new[order], score[order]
                    best[slot] = new, score
            if len(best) > 20_000:
                yield flush()
        yield flush()

    wanted = anchors.select("group", F.col("x").alias("ax"), "own", "wants")
    joined = chosen.join(wanted, "group").join(table.select("block", "ids", "x"), "block")
    return joined.mapInArrow(run, "slot long, id long, score long")


def first_k(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per slot with their rank."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_wants(groups: DataFrame, wants: DataFrame) -> DataFrame:
    """Blocks of anchors with their wants (``group, anchor, slot, least, most``) in one binary column; those without are left out."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in column_of(b, "wants").to_pylist():
                out.append(np.array([(w["anchor"], w["slot"], w["least"], w["most"]) for w in row], WANT).tobytes())
            yield batch_of(b, ["group"], wants=pa.array(out, pa.binary()))

    lists = wants.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("anchor", "slot", "least", "most"))).alias("wants"))
    packed = lists.mapInArrow(pack, "group long, wants binary")
    return groups.drop("wants").join(packed, "group")


def _search(
    groups: DataFrame, wants: DataFrame, table: DataFrame, shelf_table: DataFrame, n_shelves: int, length: int, same: bool, k: int
) -> DataFrame:
    """The first ``k`` rows of every want: ``slot, id, score, rank``, exactly.

    The k-th best of the first blocks raises the lower end of a window; only blocks whose bounds
    still meet it are read in the second step.
    """
    asked = materialise(_with_wants(groups, wants), "asked")
    seeds = choose_seeds(asked, shelf_table, n_shelves, length, same, k)
    first = first_k(read_blocks(seeds, asked, table, length, same, k), k).where(F.col("rank") == k)
    raised = wants.join(first.select("slot", F.col("score").alias("kth")), "slot", "left")
    raised = raised.withColumn("least", F.greatest("least", F.coalesce("kth", "least"))).drop("kth")
    narrowed = materialise(_with_wants(groups, raised), "narrowed")
    chosen = choose_blocks(narrowed, shelf_table, n_shelves, length, same)
    out = materialise(first_k(read_blocks(chosen, narrowed, table, length, same, k), k), "found")
    discard(asked)
    discard(narrowed)
    return out


def hard_negatives(
    rows: DataFrame,
    is_anchor,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "x",
    n_positives: int = 5,
    n_negatives: int = 10,
    least: int = 30,
    most: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector_col`` holds integers; a score is an inner product. The positives of an anchor are its
    first ``n_positives`` other rows of the same label by falling score, ties by the smaller id.
    For each, the first ``n_negatives`` rows of other labels whose score is between ``least`` and
    ``most`` percent of the positive's are returned. Below a score of 0 that window is empty.

    Rows with a null id, label or vector, or a null entry, take no part; shorter vectors count
    as filled up with zeros. Repeated rows count as often as they occur, but a row that has the
    anchor's id is never its positive. An anchor that occurs twice gives its rows twice. A table
    without rows, anchors, positives or negatives gives no rows. Other columns are ignored. A
    score past the range of a long is an error.
    """
    given = rows.select(F.col(id_col).alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("x"), is_anchor.alias("is_anchor"))
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & is_whole(F.col("x")))
    length = longest(given, "x")
    ready = given.withColumn("x", padded(F.col("x"), length, F.lit(0).cast("long")))
    curve = curve_of(ready, length)
    placed = with_place(ready, length, curve)
    table = blocks(placed.drop("is_anchor"), length, BLOCK_ROWS)
    groups = blocks(placed.where("is_anchor").drop("is_anchor"), length, ANCHOR_ROWS)
    groups = groups.select(F.col("block").alias("group"), "label", "n", F.col("ids").alias("own"), "x")
    shelf_table, n_shelves = shelves(table, length)
    n_shelves = max(1, n_shelves)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.select(["group", "own"]).to_pylist():
                own = np.frombuffer(r["own"], np.int64)
                group = np.full(len(own), r["group"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(np.arange(len(own), dtype=np.int32)), pa.array(own)], ["group", "anchor", "anchor_id"])

    # Groups number tasks times 2^32 plus a count, so that a slot of each anchor fits a long.
    anchors = groups.select("group", "own").mapInArrow(number, "group long, anchor int, anchor_id long")
    of_group = (F.shiftright("group", 32) * (1 << 20) + F.col("group").bitwiseAND(F.lit((1 << 20) - 1))) * ANCHOR_ROWS
    anchors = materialise(anchors.withColumn("slot", of_group + F.col("anchor")), "anchors")
    wants = anchors.select("group", "anchor", "slot", F.lit(ANY[0]).alias("least"), F.lit(ANY[1]).alias("most"))
    positives = _search(groups, wants, table, shelf_table, n_shelves, length, True, n_positives)
    each = positives.join(anchors, "slot").select(
        "group",
        "anchor",
        "anchor_id",
        (F.col("slot") * n_positives + F.col("rank") - 1).alias("slot"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    each = materialise(each, "windows")
    # Exact ends in whole numbers: the least and greatest score of the window.
    lowest = F.ceil(F.col("positive_score").cast("decimal(38,0)") * least / 100).cast("long")
    highest = F.floor(F.col("positive_score").cast("decimal(38,0)") * most / 100).cast("long")
    wants = each.select("group", "anchor", "slot", lowest.alias("least"), highest.alias("most")).where("least <= most")
    negatives = _search(groups, wants, table, shelf_table, n_shelves, length, False, n_negatives)
    return negatives.join(each, "slot").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
