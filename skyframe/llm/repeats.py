"""Remove byte passages that occurred before, by naming substrings of doubling length.

A suffix array built by prefix doubling ranks every position by 1, 2, 4, ... bytes and goes on
only with ranks that are shared. Here the same is done on anchors: of the 24-byte strings in
each 100-byte window, the one with the least hash, leftmost first. Equal windows choose the
same anchor, so one position in about 35 stands for all. Names are hashes of 2h bytes made from
the names of two halves h apart, the pair that prefix doubling sorts, and rounds go

* 24 bytes: anchors whose string occurs once are done;
* the whole stretch of windows that chose an anchor: all but its first occurrence are removed;
* 88 bytes, around the anchors that are left: parts shared by no other anchor are done;
* 100 bytes, the threshold: windows that occurred before are removed.

Spark sorts names and places over all tasks, which may part a large group, so a passage in
thousands of documents is no hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import as_bytes, materialise, schema_of
from skyframe.session import discard

LENGTH = 100
ANCHOR = 24
#: Windows are told apart by how far in their anchor lies, in steps of this; the bytes that all
#: windows of a step share are ``LENGTH - STEP + 1`` long.
STEP = 13
SHARED = LENGTH - STEP + 1
#: Bytes handled at once; a longer text is cut into stretches that overlap.
CHUNK = 1 << 18
#: The filter of repeated anchors holds this many bits (16 MB), whatever the number of documents.
#: A false hit costs a row, never a result.
FILTER_BITS = 27

BASE = 0x9E3779B97F4A7C15
VALUES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class Names:
    """Names of the substrings of a byte array, for lengths that are sums of powers of two."""

    def __init__(self, data: np.ndarray):
        self.of = {1: VALUES[data]}

    def power(self, h: int) -> np.ndarray:
        if h not in self.of:
            half = self.power(h // 2)
            self.of[h] = half[: -(h // 2)] * _power(h // 2) + half[h // 2 :]
        return self.of[h]

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        out, done = np.zeros(len(starts), np.uint64), 0
        for bit in range(length.bit_length() - 1, -1, -1):
            if length >> bit & 1:
                out = out * _power(1 << bit) + self.power(1 << bit)[starts + done]
                done += 1 << bit
        return out

    def all(self, length: int) -> np.ndarray:
        n = len(self.of[1]) - length + 1
        return self.at(np.arange(n), length) if n > 0 else np.zeros(0, np.uint64)


def stretches(texts: Iterator[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, bytes) in lists of about ``CHUNK`` bytes; each window lies in exactly one."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
            part = text[at : at + CHUNK + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if size and size + len(part) > CHUNK:
                yield held
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
    if held:
        yield held


class Anchors:
    """The anchors of a list of stretches: where they are, and the windows that chose them."""

    def __init__(self, held: list[tuple[int, int, bytes]]):
        data = np.frombuffer(b"".join(part for _, _, part in held), np.uint8)
        sizes = np.array([len(part) for _, _, part in held])
        first = np.cumsum(sizes) - sizes
        self.names = Names(data)
        eight, sixteen = self.names.power(8), self.names.power(16)
        plain = sixteen[:-8] * _power(8) + eight[16:]
        bits = int(len(plain)).bit_length()
        low = np.uint64((1 << bits) - 1)
        # The place in the low bits makes the leftmost of equal strings the least.
        least = (_mix(plain) & ~low) | np.arange(len(plain), dtype=np.uint64)
        wide = LENGTH - ANCHOR + 1
        span = 1
        while span * 2 <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
        chosen = (least & low).astype(np.int64)
        # A window must end inside its own stretch.
        inside = np.zeros(len(chosen) + 1, np.int8)
        inside[first] = 1
        inside[np.minimum(first + sizes - LENGTH + 1, len(chosen))] -= 1
        starts = np.flatnonzero(np.cumsum(inside[:-1]))
        anchor = chosen[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(starts)) - 1
        self.anchor, self.low, self.high = anchor[head], starts[head], starts[tail]
        part = np.searchsorted(first, self.low, "right") - 1
        self.text = np.array([i for i, _, _ in held])[part]
        self.shift = np.array([at for _, at, _ in held])[part] - first[part]
        self.key = _mix(plain[self.anchor] + np.uint64(1)).view(np.int64)

    def keep(self, mask: np.ndarray) -> None:
        for name in ("anchor", "low", "high", "text", "shift", "key"):
            setattr(self, name, getattr(self, name)[mask])

    def contexts(self) -> np.ndarray:
        """A name for all bytes of the windows of an anchor and the anchor's place among them."""
        ends = self.names.at(self.low, LENGTH) * np.uint64(3) ^ _mix(self.names.at(self.high, LENGTH))
        shape = ((self.high - self.low) * LENGTH + self.anchor - self.low).astype(np.uint64)
        return _mix(ends + shape * np.uint64(BASE)).view(np.int64)

    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """For each step that an anchor has windows in: the anchor's number, and the step."""
        near, far = (self.anchor - self.high) // STEP, (self.anchor - self.low) // STEP
        sizes = far - near + 1
        own = np.repeat(np.arange(len(sizes)), sizes)
        return own, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + near[own]

    def step_names(self) -> pa.ListArray:
        own, step = self.steps()
        names = _mix(self.names.at(self.anchor[own] - STEP * step, SHARED) * np.uint64(5) + step.astype(np.uint64))
        offsets = np.searchsorted(own, np.arange(len(self.anchor) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(names.view(np.int64)))

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor's number and start of every window."""
        sizes = self.high - self.low + 1
        own = np.repeat(np.arange(len(sizes)), sizes)
        return own, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.low[own]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _repeated_filter(rows: DataFrame):
    """Keys that occur twice or more, as a bitmap of fixed size in a broadcast variable."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in stretches(as_bytes(batch.column(0))):
                yield pa.RecordBatch.from_arrays([pa.array(Anchors(held).key)], ["key"])

    bit = F.col("key").bitwiseAND((1 << FILTER_BITS) - 1)
    maps = (
        rows.select("text")
        .mapInArrow(keys, "key long")
        .groupBy("key")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .groupBy(F.shiftright(bit, 15).alias("slot"))
        .agg(F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits"))
    )
    whole = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for r in materialise(maps, "repeated-anchors").toLocalIterator():
        whole[r["slot"] * 4096 : (r["slot"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(whole)


ANCHOR_ROW = "text_hash long, anchor int, low int, high int, key long, context long, steps array<long>"


def _anchor_rows(rows: DataFrame, repeated) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = repeated.value
        for batch in batches:
            for held in stretches(as_bytes(batch.column(2))):
                a = Anchors(held)
                bit = a.key & ((1 << FILTER_BITS) - 1)
                a.keep((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool))
                row = pa.array(a.text)
                place = [pa.array((x + a.shift).astype(np.int32)) for x in (a.anchor, a.low, a.high)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), *place, pa.array(a.key), pa.array(a.contexts()), a.step_names()],
                    ["id", "text_hash", "anchor", "low", "high", "key", "context", "steps"],
                )

    fields = T._parse_datatype_string(ANCHOR_ROW).fields
    return rows.mapInArrow(find, schema_of(rows.select("id"), *[(f.name, f.dataType) for f in fields]))


def _window_rows(rows: DataFrame) -> DataFrame:
    """Every window of the listed steps of the listed anchors: its name and where it starts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(3).to_pylist()
            for held in stretches(as_bytes(batch.column(2))):
                a = Anchors(held)
                want = {i: np.array(wanted[i], np.int64) for i in set(a.text.tolist())}
                own, step = a.steps()
                code = (a.anchor + a.shift)[own] * 8 + step
                mine = np.zeros(len(own), bool)
                for i, codes in want.items():
                    here = a.text[own] == i if len(want) > 1 else np.ones(len(own), bool)
                    mine |= here & np.isin(code, codes)
                chosen = np.zeros((len(a.anchor), 8), bool)
                chosen[own[mine], step[mine]] = True
                a_own, start = a.windows()
                hit = chosen[a_own, (a.anchor[a_own] - start) // STEP]
                a_own, start = a_own[hit], start[hit]
                row = pa.array(a.text[a_own])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array((start + a.shift[a_own]).astype(np.int32)),
                        pa.array(a.key[a_own]),
                        pa.array(_mix(a.names.at(start, LENGTH)).view(np.int64)),
                    ],
                    ["id", "text_hash", "start", "key", "name"],
                )

    more = [("text_hash", T.LongType()), ("start", T.IntegerType()), ("key", T.LongType()), ("name", T.LongType())]
    return rows.mapInArrow(find, schema_of(rows.select("id"), *more))


def _firsts(rows: DataFrame, keys: list[str], start: str, label: str, only_first: tuple[str, ...] = ()) -> DataFrame:
    """``rows``, written, with ``first``: whether no row of the same keys starts earlier. The keys are gone.

    Spark sorts rows by keys and place over all tasks. Where a task begins inside a group, as it
    may inside a large one, its first row is put right by the last keys of the task before.
    Columns in ``only_first`` are null on other rows.
    """
    by = [*keys, "id", start]
    kept = [c for c in rows.columns if c not in keys]
    edge = [f"edge_{k}" for k in keys]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, held, lead = TaskContext.get().partitionId(), None, None, True

        def out(batch: pa.RecordBatch, first: np.ndarray, early: np.ndarray, begins: bool, ends: bool) -> pa.RecordBatch:
            edges = np.full(len(first), -1, np.int32)
            edges[-1] = 1 if ends else -1
            edges[0] = 0 if begins else edges[0]
            at_edge = pa.array(edges >= 0)
            mask = pa.array(first)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns = [pc.if_else(mask, x, pa.scalar(None, x.type)) if c in only_first else x for c, x in zip(kept, columns, strict=True)]
            keyed = [pc.if_else(at_edge, batch.column(batch.schema.get_field_index(k)), pa.scalar(None, pa.int64())) for k in keys]
            return pa.RecordBatch.from_arrays(
                [*columns, mask, pa.array(np.full(len(first), task, np.int32)), pa.array(early), pa.array(edges), *keyed],
                [*kept, "first", "task", "early", "edge", *edge],
            )

        begins = True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
            new = np.ones(n, bool)
            new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
            ids, at = batch.column(batch.schema.get_field_index("id")), batch.column(batch.schema.get_field_index(start)).to_numpy()
            moved = np.ones(n, bool)
            moved[1:] = (at[1:] != at[:-1]) | ~_equal(ids.slice(1), ids.slice(0, n - 1))
            if last is not None:
                new[0] = any(v[0] != x for v, x in zip(values, last[0], strict=True))
                moved[0] = new[0] or at[0] != last[1] or not _equal(ids.slice(0, 1), last[2])[0]
            # Rows at one place are one: all of them are first, or none.
            run = np.maximum.accumulate(np.where(new | moved, np.arange(n), -1))
            first = np.where(run >= 0, new[run], last[3] if last is not None else True)
            early = np.full(n, False)
            if lead:
                ahead = np.flatnonzero((new | moved) & (np.arange(n) + (last is not None) > 0))
                early[: ahead[0] if len(ahead) else n] = True
                lead = not len(ahead)
            last = [v[-1] for v in values], at[-1], ids.slice(n - 1), bool(first[-1])
            if held is not None:
                yield out(*held, begins, False)
                begins = False
            held = batch, first, early
        if held is not None:
            yield out(*held, begins, True)

    more = [("first", T.BooleanType()), ("task", T.IntegerType()), ("early", T.BooleanType()), ("edge", T.IntegerType()), *[(e, T.LongType()) for e in edge]]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    marked = materialise(ordered.mapInArrow(mark, schema_of(rows.select(*kept), *more)), label)
    # Two rows per task at most: where it begins (edge 0) and where it ends. One row can be both.
    wrong, before = [], None
    for r in sorted(marked.where("edge >= 0").select("task", "edge", *edge).collect(), key=lambda r: (r["task"], r["edge"])):
        own = tuple(r[e] for e in edge)
        if r["edge"] == 0 and own == before:
            wrong.append(r["task"])
        before = own
    inside = F.col("early") & F.col("task").isin(wrong)
    return marked.withColumn("first", F.col("first") & ~inside).select(*kept, "first")


def _equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether values are equal, or both null."""
    same = pc.fill_null(pc.equal(a, b), False)
    return pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _same_text(keys: DataFrame):
    return F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_text_hash"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, span``: bytes to remove, as first byte times 2^32 plus the byte after the last; spans may overlap."""
    rows = _keyed(docs, id_col, text_col)
    anchors = materialise(_anchor_rows(rows, _repeated_filter(rows)), "anchors")
    judged = _firsts(anchors, ["key", "context"], "low", "anchor-contexts", only_first=("steps",))
    discard(anchors)
    whole = judged.where(~F.col("first")).select("id", "text_hash", _span(F.col("low"), F.col("high") + LENGTH))
    nearest = F.floor((F.col("anchor") - F.col("high")) / STEP).cast("int")
    steps = judged.where("first").select("id", "text_hash", "anchor", F.posexplode("steps").alias("at", "name"), nearest.alias("nearest"))
    shared = steps.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    wanted = (
        steps.join(shared, "name")
        .groupBy("id", "text_hash")
        .agg(F.collect_list(F.col("anchor").cast("long") * 8 + F.col("nearest") + F.col("at")).alias("wanted"))
        .select(F.col("id").alias("_id"), F.col("text_hash").alias("_text_hash"), "wanted")
    )
    again = rows.join(wanted, _same_text(wanted)).select("id", "text_hash", "text", "wanted")
    windows = materialise(_window_rows(again), "windows")
    late = _firsts(windows, ["key", "name"], "start", "window-names").where(~F.col("first"))
    discard(windows)
    return whole.unionByName(late.select("id", "text_hash", _span(F.col("start"), F.col("start") + LENGTH)))


def _span(low, end):
    return (F.shiftleft(low.cast("long"), 32) + end).alias("span")


def union_of(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching (low, end) rows made one; sorted."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    heads = np.flatnonzero(new)
    return np.column_stack([spans[heads, 0], reach[np.append(heads[1:], len(spans)) - 1]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, kept, n_bytes, n_removed, n_spans`` per row: what is left of the UTF-8 of each text.

    A byte goes if a 100-byte string that covers it also starts earlier: in a document with a
    smaller id, or before it in the same one. All strings are judged on the input. A null text is
    empty; a text of under 100 bytes stays whole. A null id comes first. Rows that repeat an id
    count as one document whose texts start together, so they remove nothing from each other at
    equal places. Other columns are ignored; an empty table gives no rows.
    """
    spans = (
        repeated_spans(docs, id_col, text_col)
        .groupBy("id", "text_hash")
        .agg(F.collect_list("span").alias("spans"))
        .select(F.col("id").alias("_id"), F.col("text_hash").alias("_text_hash"), "spans")
    )
    spans = materialise(spans, "spans")
    rows = _keyed(docs, id_col, text_col)
    joined = rows.join(spans, _same_text(spans), "left").select("id", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column(2)
            kept, numbers = [], []
            for i, text in enumerate(as_bytes(batch.column(1))):
                if not gone[i].is_valid:
                    kept.append(text)
                    numbers.append((len(text), 0, 0))
                    continue
                packed = gone[i].values.to_numpy()
                cut = union_of(np.column_stack([packed >> 32, packed & 0xFFFFFFFF]))
                edges = [0, *cut.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                numbers.append((len(text), len(text) - len(kept[-1]), len(cut)))
            columns = np.array(numbers, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), *map(pa.array, columns)],
                [id_col, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    more = [("kept", T.BinaryType()), *[(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]]
    return joined.mapInArrow(remove, schema_of(docs.select(id_col), *more))
