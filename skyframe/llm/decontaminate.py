"""Find verbatim passages of a test set in training documents with suffix arrays.

Each task turns the documents it holds into suffix arrays, a bounded number of words at a
time, and looks every test suffix up by binary search. Documents never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import as_bytes, materialise, schema_of
from skyframe.session import discard

WINDOW = 13
#: Bytes of test text that one pass over the documents looks up; a larger set takes more passes.
BLOCK_BYTES = 16 << 20
#: Bytes of documents in one suffix array.
SHARD_BYTES = 4 << 20
#: Words of a suffix that the arrays are sorted by; longer matches sort what is tied by the next so many words.
DEPTH = 32
#: Test suffixes that are compared at once.
COMPARED = 1 << 16

#: Word bytes are digits, letters (in lower case) and all bytes of non-ASCII characters.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def rows_as_keys(matrix: np.ndarray) -> np.ndarray:
    """Rows of word numbers as strings that sort in the same order; trailing zeros are no words."""
    wide = np.ascontiguousarray(matrix, ">u4")
    return wide.view(f"S{4 * wide.shape[1]}").ravel()


def rows_at(ids: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` word numbers from each place on; words after the first zero belong to no common run."""
    rows = np.lib.stride_tricks.sliding_window_view(ids, depth)[at].astype(np.uint32)
    rows[np.maximum.accumulate(rows == 0, axis=1)] = 0
    return rows


def grouped_keys(group: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return rows_as_keys(np.column_stack([group.astype(np.uint32), rows]))


def smallest_within(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The smallest of ``values[lo:hi]`` for every pair; none is empty. Each step doubles the reach of the minima."""
    out = np.empty(len(lo), values.dtype)
    level = np.frexp(hi - lo)[1] - 1
    reach = values
    for step in range(int(level.max(initial=-1)) + 1):
        if step:
            reach = np.minimum(reach[: -(1 << step - 1)], reach[1 << step - 1 :])
        mine = np.flatnonzero(level == step)
        out[mine] = np.minimum(reach[lo[mine]], reach[hi[mine] - (1 << step)])
    return out


@dataclass
class TestSet:
    """A block of test items: word numbers, the place of every suffix, and the windows among them.

    Sort keys are made from the word numbers where they are needed, so a block holds a few
    numbers for each of its words.
    """

    __test__ = False

    vocabulary: dict[bytes, int]
    ids: list[str]
    depth: int
    pairs: np.ndarray
    alone: np.ndarray
    words: np.ndarray
    suffix_item: np.ndarray
    suffix_start: np.ndarray
    suffix_place: np.ndarray
    window_place: np.ndarray
    window_size: np.ndarray
    #: Items of window ``w``: ``item[first[w]:first[w + 1]]``.
    window_first: np.ndarray
    window_item: np.ndarray


def build_test_set(items: list[tuple[str, bytes]], window: int) -> TestSet:
    vocabulary: dict[bytes, int] = {}
    numbers = [np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)), np.uint32) for _, t in items]
    depth = max(DEPTH, window)
    size = np.array([len(n) for n in numbers], np.int64)
    # A zero ends each item, and enough of them the last one.
    gap = np.zeros(1, np.uint32)
    words = np.concatenate([x for n in numbers for x in (n, gap)] + [np.zeros(depth, np.uint32)])
    first = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)[:-1]
    item = np.repeat(np.arange(len(items)), size)
    place = np.flatnonzero(words)
    start = place - first[item]
    next_to = place[words[place + 1] > 0]
    begins = start <= np.maximum(size[item] - window, 0)
    rows = rows_at(words, place[begins], window)
    _, where, number = np.unique(rows_as_keys(rows), return_index=True, return_inverse=True)
    owned = np.unique(number * max(1, len(items)) + item[begins])
    return TestSet(
        vocabulary,
        [i for i, _ in items],
        depth,
        np.unique(words[next_to].astype(np.int64) << 32 | words[next_to + 1]),
        np.unique(words[place[(size[item] == 1) | (window == 1)]]).astype(np.int64),
        words,
        item,
        start,
        place,
        place[begins][where],
        (rows[where] > 0).sum(axis=1),
        np.searchsorted(owned, np.arange(len(where) + 1) * max(1, len(items))),
        owned % max(1, len(items)),
    )


class Shard:
    """The suffix array of some documents, without suffixes that no test suffix can meet.

    A suffix is left out if its first two words never stand together in the test set (and its
    first word is no item by itself): every match of two words or more begins with such a pair.
    """

    def __init__(self, tests: TestSet, texts: list[bytes]):
        look = tests.vocabulary.get
        words = [np.fromiter((look(w, 0) for w in words_of(t)), np.int64) for t in texts]
        self.n_words = np.array([len(w) for w in words], np.int64)
        depth = tests.depth
        # A zero parts documents, so that no match runs from one to the next.
        gap = np.zeros(1, np.int64)
        self.ids = np.concatenate([x for w in words for x in (w, gap)] + [np.zeros(depth, np.int64)])
        self.first = np.concatenate([[0], np.cumsum(self.n_words + 1)])[:-1] if texts else np.zeros(0, np.int64)
        here = np.flatnonzero(self.ids[:-1])
        pair = self.ids[here] << 32 | self.ids[here + 1]
        at = np.searchsorted(tests.pairs, pair)
        can = tests.pairs[np.minimum(at, len(tests.pairs) - 1)] == pair if len(tests.pairs) else np.zeros(len(pair), bool)
        if len(tests.alone):
            can |= np.isin(self.ids[here], tests.alone)
        here = here[can]
        keys = rows_as_keys(rows_at(self.ids, here, depth))
        order = np.argsort(keys, kind="stable")
        self.starts, self.keys = here[order], keys[order]

    def ranges(self, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of each window in the suffix array."""
        lo, hi = (np.empty(len(tests.window_place), np.int64) for _ in range(2))
        for at in range(0, len(lo), COMPARED):
            part = slice(at, at + COMPARED)
            rows = rows_at(tests.words, tests.window_place[part], tests.depth)
            past = np.arange(tests.depth) >= tests.window_size[part, None]
            lo[part] = np.searchsorted(self.keys, rows_as_keys(np.where(past, 0, rows)), "left")
            hi[part] = np.searchsorted(self.keys, rows_as_keys(np.where(past, 0xFFFFFFFF, rows)), "right")
        return lo, hi

    def windows(self, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
        """Every occurrence of every window: its number and the word it starts at."""
        lo, hi = self.ranges(tests)
        found = np.flatnonzero(hi > lo)
        sizes = (hi - lo)[found]
        number = np.repeat(found, sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo[found], sizes)
        return number, self.starts[place]

    def longest(self, tests: TestSet, least: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Test suffixes that share ``least`` words or more with a place here, how many they share at most, and where.

        Of places that share equally many, the one in the document of the smallest ``rank`` stays,
        and there the first. Places that share all words of their keys are sorted by the next
        words, as often as some test suffix goes on; no length is cut.
        """
        found = [np.zeros(0, np.int64)] * 3
        if not len(self.keys):
            return tuple(found)
        depth = self.keys.dtype.itemsize // 4
        owner = np.searchsorted(self.first, self.starts, "right") - 1
        # Places by rank of their document, then by place in the document.
        by_choice = np.lexsort((self.starts - self.first[owner], rank[owner]))
        choice = np.empty(len(by_choice), np.int64)
        choice[by_choice] = np.arange(len(by_choice))
        chosen_start = self.starts[by_choice]
        starts, group = self.starts, np.ones(len(self.starts), np.int64)
        suffix, suffix_group = np.arange(len(tests.suffix_place)), np.ones(len(tests.suffix_place), np.int64)
        done = 0
        while len(suffix):
            rows = rows_at(self.ids, starts + done, depth)
            keys = grouped_keys(group, rows)
            # The first keys are sorted; those of later rounds are in order of their group only.
            order = np.argsort(keys, kind="stable")
            keys, starts, choice = keys[order], starts[order], choice[order]
            have = keys.view(">u4").reshape(-1, depth + 1)
            more = []
            for cut in range(0, len(suffix), COMPARED):
                mine, own = suffix[cut : cut + COMPARED], suffix_group[cut : cut + COMPARED]
                wanted = np.column_stack([own, rows_at(tests.words, tests.suffix_place[mine] + done, depth)]).astype(np.uint32)
                at = np.searchsorted(keys, rows_as_keys(wanted))
                same = np.zeros(len(mine), np.int64)
                for near in (np.maximum(at - 1, 0), np.minimum(at, len(keys) - 1)):
                    equal = np.logical_and.accumulate((have[near] == wanted) & (wanted > 0), axis=1).sum(axis=1)
                    same = np.maximum(same, equal - 1)
                good = np.flatnonzero(done + same >= least)
                mine, same, wanted = mine[good], same[good], wanted[good]
                past = np.arange(depth + 1) > same[:, None]
                lo = np.searchsorted(keys, rows_as_keys(np.where(past, 0, wanted)), "left")
                hi = np.searchsorted(keys, rows_as_keys(np.where(past, 0xFFFFFFFF, wanted)), "right")
                on = (same == depth) & (tests.words[tests.suffix_place[mine] + done + depth] > 0)
                more.append((mine[on], lo[on], hi[on]))
                best = smallest_within(choice, lo[~on], hi[~on])
                found = [np.concatenate(x) for x in zip(found, (mine[~on], done + same[~on], chosen_start[best]), strict=True)]
            # Equal ranges are one group; different ones have no place in common.
            suffix, lo, hi = (np.concatenate(x) for x in zip(*more, strict=True))
            lo, suffix_group = np.unique(lo, return_inverse=True)
            sizes = np.zeros(len(lo), np.int64)
            sizes[suffix_group] = hi - lo[suffix_group]
            suffix_group = suffix_group + 1
            group = np.repeat(np.arange(1, len(lo) + 1), sizes)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo, sizes)
            starts, choice = starts[place], choice[place]
            done += depth
        order = np.argsort(found[0])
        return tuple(x[order] for x in found)


def _shards(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SHARD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _blocks(tests: DataFrame, item_col: str, text_col: str, window: int) -> Iterator[tuple[Broadcast, bool]]:
    """The test set as broadcast variables of bounded size, one for each pass, and whether more follow.

    The driver and the tasks hold one block at a time, if each is destroyed before the next is asked for.
    """
    size = tests.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    context = tests.sparkSession.sparkContext
    for b in range(blocks):
        part = tests.select(F.col(item_col).cast("string"), F.col(text_col)).where(F.col(text_col).isNotNull())
        if blocks > 1:
            part = part.where(F.pmod(F.xxhash64(item_col), F.lit(blocks)) == b)
        items = [(str(r[0]), r[1].encode()) for r in part.toLocalIterator()]
        yield context.broadcast(build_test_set(items, window)), b + 1 < blocks


def contamination(
    docs: DataFrame,
    tests: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    test_id: str = "item_id",
    test_text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (word spans inside test windows) and ``items`` (their ids).

    A window is ``window`` consecutive words of an item, or the whole of a shorter item. Spans
    are (first word, word after the last), merged where they overlap or touch. A null text has no
    words and no hits; a null item id is called ``None``; an empty test set hits nothing, and without
    documents there are no rows. Rows that repeat are judged alike, and items that repeat an id count once.
    Columns of ``docs`` with the added names are replaced. Rows stay in their tasks. A test set of
    up to ``BLOCK_BYTES`` takes one pass; of a larger one, each pass but the last is written.
    """
    spans = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    kept = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    out = docs.select(
        *kept,
        F.lit(None).cast("long").alias("n_words"),
        F.array().cast(spans).alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    written = None
    for block, more in _blocks(tests, test_id, test_text, window):
        out = out.mapInArrow(_scan(block, text_col, kept), schema_of(out))
        if more:
            before, written = written, materialise(out, "contamination")
            block.destroy()
            if before is not None:
                discard(before)
            out = written
    return out


def _scan(block, text_col: str, kept: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = block.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            before_hits = batch.column(batch.schema.get_field_index("hits"))
            before_items = batch.column(batch.schema.get_field_index("items"))
            n_words, hits, items = [], [], []
            for texts in _shards(as_bytes(column)):
                shard = Shard(tests, texts)
                number, start = shard.windows(tests)
                end = start + tests.window_size[number]
                owner = np.searchsorted(shard.first, start, "right") - 1
                order = np.lexsort((start, owner))
                cut = np.searchsorted(owner[order], np.arange(len(texts) + 1))
                for i in range(len(texts)):
                    row = len(n_words)
                    n_words.append(int(shard.n_words[i]))
                    mine = order[cut[i] : cut[i + 1]]
                    own = [(s["first"], s["end"]) for s in before_hits[row].as_py()]
                    found = set(before_items[row].as_py())
                    if len(mine):
                        base = shard.first[i]
                        own += zip((start[mine] - base).tolist(), (end[mine] - base).tolist(), strict=True)
                        for w in np.unique(number[mine]).tolist():
                            found.update(tests.ids[n] for n in tests.window_item[tests.window_first[w] : tests.window_first[w + 1]].tolist())
                    hits.append([{"first": a, "end": b} for a, b in merged(own)])
                    items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(c)) for c in kept],
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, before_hits.type),
                    pa.array(items, before_items.type),
                ],
                [*kept, "n_words", "hits", "items"],
            )

    return scan


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def n_hit():
    return F.aggregate("hits", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])


def contaminated(share: int = 20):
    """At least one of ``share`` words is hit."""
    return (n_hit() > 0) & (share * n_hit() >= F.col("n_words"))


def longest_matches(
    docs: DataFrame,
    tests: DataFrame,
    least: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    test_id: str = "item_id",
    test_text: str = "text",
) -> DataFrame:
    """For every test suffix its longest verbatim match of ``least`` words or more: ``item_id, item_start, n_words, doc_id, doc_start, n_shared``.

    ``n_shared`` is the length of the whole passage, however long, and the place is that of the
    longest; of equal lengths, the smallest document and place stay. ``n_words`` is that length
    counted up to ``DEPTH`` words (or ``least``, if that is more). Each suffix array answers with
    one row per test suffix at most.
    """
    names = ["item_id", "item_start", "n_shared", "doc_id", "doc_start"]
    rows = docs.select(id_col, text_col)
    schema = T.StructType(
        [T.StructField("item_id", T.StringType()), *[T.StructField(n, T.LongType()) for n in names[1:3]], T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("doc_start", T.LongType())]
    )

    def searcher(block):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = block.value
            for batch in batches:
                ids, done = batch.column(0), 0
                for texts in _shards(as_bytes(batch.column(1))):
                    shard = Shard(tests, texts)
                    own = pc.rank(ids.slice(done, len(texts)), null_placement="at_start", tiebreaker="dense").to_numpy()
                    suffix, best, where = shard.longest(tests, least, own)
                    owner = np.searchsorted(shard.first, where, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([tests.ids[i] for i in tests.suffix_item[suffix]], pa.string()),
                            pa.array(tests.suffix_start[suffix]),
                            pa.array(best),
                            ids.take(pa.array(owner + done, pa.int64())),
                            pa.array(where - shard.first[owner]),
                        ],
                        names,
                    )
                    done += len(texts)

        return search

    found = None
    for block, more in _blocks(tests, test_id, test_text, least):
        part = rows.mapInArrow(searcher(block), schema)
        if more:
            part = materialise(part, "longest-matches")
            block.destroy()
        found = part if found is None else found.unionByName(part)
    lead = found.groupBy("item_id", "item_start").agg(F.min(F.struct((-F.col("n_shared")).alias("n"), "doc_id", "doc_start")).alias("b"))
    n_shared = -F.col("b.n")
    n_words = F.least(n_shared, F.lit(max(DEPTH, least)).cast("long"))
    return lead.select("item_id", "item_start", n_words.alias("n_words"), "b.doc_id", "b.doc_start", n_shared.alias("n_shared"))
