"""Pack token sequences into rows of one length by their length histogram."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import materialise, schema_of

#: White space in a row from which a text is encoded by the file itself: the fast pattern looks
#: ahead behind white space and keeps a place on its stack for each.
LONG_SPACE = 100_000
SPACES = re.compile(r"\s+")


def encoder(json_path: str, ranks_path: str, pattern: str):
    """A function from a text to its ids, equal to what the ``tokenizers`` file gives.

    The rank file holds the same vocabulary and is encoded about five times as fast. It takes
    all texts but those with one of the file's special strings, which only the file knows, or a
    very long run of white space.
    """
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    specials = [t.content for t in slow.get_added_tokens_decoder().values()]

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in specials) or (len(text) >= LONG_SPACE and longest_space(text) >= LONG_SPACE):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def longest_space(text: str) -> int:
    return max((m.end() - m.start() for m in SPACES.finditer(text)), default=0)


def token_pieces(
    docs: DataFrame,
    files: tuple[str, str, str],
    size: int,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, block, rank``.

    Each text is encoded, ``end_id`` is added, and the ids are cut every ``size``. ``block`` is
    the number of the task and ``rank`` counts the pieces of equal length inside it, so that a
    place among all pieces of a length follows from counts per block, without sorting them.
    """

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files)
        block = TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            of, rows = [], []
            for i, scalar in enumerate(batch.column(1)):
                ids = np.concatenate([encode(scalar.as_py() or ""), end]).astype("<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    of.append(i)
                    rows.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids), block, seen[len(piece)]))
                    seen[len(piece)] += 1
            numbers = np.array(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), *map(pa.array, numbers.T)],
                [id_col, "start", "length", "ids_crc32", "doc_tokens", "block", "rank"],
            )

    names = ["start", "length", "ids_crc32", "doc_tokens", "block", "rank"]
    return docs.select(id_col, text_col).mapInArrow(
        encode_all, schema_of(docs.select(id_col), *[(n, T.LongType()) for n in names])
    )


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Patterns of lengths and how often each is used, from counts per length alone.

    Lengths are placed longest first, each into the open pack that holds least. Packs of one
    pattern are handled together by their count. Where no open pack has room, new ones are
    opened, each with as many copies of the length as fit. A length opens at most two patterns
    and splits at most one, so there are at most three patterns per distinct length.
    """
    room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if length > size or length < 1:
            raise ValueError(f"no pack of {size} holds a length of {length}")
        at = size
        while left and at >= length:
            if not room[at]:
                at -= 1
                continue
            count, pattern = room[at].pop()
            used = min(count, left)
            if used < count:
                room[at].append((count - used, pattern))
            room[at - length].append((used, [*pattern, length]))
            left -= used
        copies = size // length
        if left >= copies:
            room[size - copies * length].append((left // copies, [length] * copies))
        if left % copies:
            room[size - (left % copies) * length].append((1, [length] * (left % copies)))
    return [x for free in sorted(room) for x in room[free]]


def places(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """Where each range of ranks of a length goes, sorted by (length, first rank)."""
    rows, taken, first = [], defaultdict(int), 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], first, offset))
            taken[length] += count
            offset += length
        first += count
    rows.sort()
    return dict(zip(("length", "rank", "sequence", "offset"), np.array(rows, np.int64).reshape(-1, 4).T, strict=True))


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """Add ``sequence_id, offset`` to rows with ``length, block, rank``; these last two are dropped.

    Only the histogram (at most ``size`` counts) comes to the driver, and only the patterns
    (bounded by ``size``, whatever the number of rows) go out. An empty table packs to nothing.
    ``pieces`` must give the same blocks and ranks each time it is read: a written table.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(places(shortest_pack_first(histogram, size)))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("block", "length").agg(F.count("*").alias("_n"))
    offsets = counts.select("block", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(offsets, ["block", "length"]).withColumn("rank", F.col("rank") + F.col("_before"))
    kept = [c for c in pieces.columns if c not in ("block", "rank")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = plan.value
        lengths, firsts = at["length"], np.searchsorted(at["length"], np.arange(size + 2))
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            slot = np.empty(len(length), np.int64)
            for value in np.unique(length):
                mine = length == value
                lo, hi = firsts[value], firsts[value + 1]
                slot[mine] = lo + np.searchsorted(at["rank"][lo:hi], rank[mine], "right") - 1
            assert not len(slot) or (lengths[slot] == length).all()
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(c)) for c in kept],
                    pa.array(at["sequence"][slot] + rank - at["rank"][slot]),
                    pa.array(at["offset"][slot]),
                ],
                [*kept, "sequence_id", "offset"],
            )

    return ranked.select(*kept, "rank").mapInArrow(
        place, schema_of(pieces.select(*kept), ("sequence_id", T.LongType()), ("offset", T.LongType()))
    )


def pack_documents(
    docs: DataFrame, files: tuple[str, str, str], size: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode, cut and pack ``docs``: one row per piece with its sequence and place there.

    A null text is empty and still holds the end id. Repeated rows are packed as often as they
    occur; null ids stay null; other columns are ignored.
    """
    return pack(materialise(token_pieces(docs, files, size, id_col=id_col, text_col=text_col), "pieces"), size)
