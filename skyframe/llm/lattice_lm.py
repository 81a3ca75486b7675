"""Probability of texts under a subword model, summed over all segmentations.

Pieces of an existing vocabulary are drawn one after another, and an end. A piece holds the mark
of a word's begin only in front, so the lattice of a text falls apart between words: its
probability is the product over its words, each summed over its own segmentations. Distinct words
are therefore scored once, from a table that Spark counts, and documents look their words up.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import as_bytes, materialise, schema_of
from skyframe.llm.words import _hash_words, mix, word_hashes

MARK = "▁"
#: Rounds of re-estimation on the training words.
ROUNDS = 2
#: How many drawn pieces the existing scores count for.
PRIOR = 1_000.0
#: Distinct words that a task counts before it hands them on.
TASK_WORDS = 300_000
#: The most frequent words, at most this many, go to all tasks; all others are joined.
DICTIONARY = 1 << 20
#: Words of one length that are scored together.
GROUP = 8_192
#: Words of more bytes are scored one by one.
LONG_WORD = 48
LN10 = math.log(10.0)

_BASE = 0xA0761D6478BD642F
_VALUES = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_FILTER = 20


def piece_scores(model: str) -> list[tuple[bytes, float]]:
    """Byte strings of a sentencepiece vocabulary with the weight its scores give them, in logarithms.

    The scores of a merge vocabulary are minus the rank of the merge; ranks become weights by
    Zipf's law. A begin-of-word mark is written as a blank. Byte pieces weigh least, and make
    every text possible. Pieces with a mark elsewhere can't occur in a word and are left out.
    """
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model)
    size = p.get_piece_size()
    weights: dict[bytes, float] = {}
    for i in range(size):
        if p.is_control(i) or p.is_unknown(i) or p.is_unused(i):
            continue
        piece = p.id_to_piece(i)
        if p.is_byte(i):
            data, rank = bytes([int(piece[3:5], 16)]), float(size)
        elif MARK in piece[1:]:
            continue
        else:
            data, rank = piece.replace(MARK, " ").encode(), -p.get_score(i)
        weights[data] = weights.get(data, 0.0) + 1.0 / (rank + 10.0)
    return [(data, math.log(w)) for data, w in weights.items()]


@dataclass
class Lattice:
    """A vocabulary with log probabilities, and lookups of byte runs in it."""

    pieces: list[bytes]
    logp: np.ndarray
    end: float

    def __post_init__(self):
        self.longest = max(map(len, self.pieces))
        steps = np.full(LONG_WORD + 2, _BASE, np.uint64)
        steps[0] = 1
        self.up = np.cumprod(steps)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        self.down = np.cumprod(steps)
        names = np.array([self._name(p) for p in self.pieces], np.uint64)
        self.order = np.argsort(names)
        self.names = names[self.order]
        self.known = np.zeros(1 << _FILTER, bool)
        self.known[names >> np.uint64(64 - _FILTER)] = True
        self.ids = {p: i for i, p in enumerate(self.pieces)}

    def _name(self, piece: bytes) -> np.uint64:
        # A piece longer than the words of the tables is met only by the search of long words.
        data = np.frombuffer(piece[: LONG_WORD + 1], np.uint8)
        total = np.cumsum(_VALUES[data] * self.up[: len(data)])[-1:]
        return mix(total + np.uint64(len(piece)))[0]

    def find(self, totals: np.ndarray, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose bytes s to e are a piece, and its number."""
        name = mix((totals[:, e] - totals[:, s]) * self.down[s] + np.uint64(e - s))
        rows = np.flatnonzero(self.known[name >> np.uint64(64 - _FILTER)])
        at = np.searchsorted(self.names, name[rows])
        at[at == len(self.names)] = 0
        same = self.names[at] == name[rows]
        return rows[same], self.order[at[same]]

    def arcs(self, words: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        n, length = words.shape
        totals = np.zeros((n, length + 1), np.uint64)
        np.cumsum(_VALUES[words] * self.up[:length], axis=1, out=totals[:, 1:])
        return {(s, e): self.find(totals, s, e) for e in range(1, length + 1) for s in range(max(0, e - self.longest), e)}

    def forward(self, arcs, n: int, length: int) -> np.ndarray:
        """Log probability of the first e bytes, for all e, by the forward recursion."""
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0.0
        for e in range(1, length + 1):
            for s in range(max(0, e - self.longest), e):
                rows, ids = arcs[s, e]
                if not len(rows):
                    continue
                alpha[e, rows] = np.logaddexp(alpha[e, rows], alpha[s, rows] + self.logp[ids])
        return alpha

    def score(self, words: np.ndarray) -> np.ndarray:
        """Log probabilities of words of one length, given as rows of bytes."""
        n, length = words.shape
        return self.forward(self.arcs(words), n, length)[length]

    def expect(self, words: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Add how often each piece is expected in the words, by forward and backward recursion."""
        n, length = words.shape
        arcs = self.arcs(words)
        alpha = self.forward(arcs, n, length)
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0.0
        for s in range(length - 1, -1, -1):
            for e in range(s + 1, min(length, s + self.longest) + 1):
                rows, ids = arcs[s, e]
                if not len(rows):
                    continue
                way = self.logp[ids] + beta[e, rows]
                beta[s, rows] = np.logaddexp(beta[s, rows], way)
                share = np.exp(alpha[s, rows] + way - alpha[length, rows]) * counts[rows]
                np.add.at(into, ids, share)

    def long_arcs(self, word: bytes) -> Iterator[list[tuple[int, int]]]:
        for e in range(1, len(word) + 1):
            yield [(s, i) for s in range(max(0, e - self.longest), e) if (i := self.ids.get(word[s:e])) is not None]

    def long_word(self, word: bytes, count: float = 0.0, into: np.ndarray | None = None) -> float:
        """The same for one word of any length."""
        alpha = np.full(len(word) + 1, -np.inf)
        alpha[0] = 0.0
        ends = []
        for e, found in enumerate(self.long_arcs(word), 1):
            alpha[e] = np.logaddexp.reduce([alpha[s] + self.logp[i] for s, i in found])
            if into is not None:
                ends.append(found)
        if into is not None:
            beta = np.full(len(word) + 1, -np.inf)
            beta[-1] = 0.0
            for e in range(len(word), 0, -1):
                for s, i in ends[e - 1]:
                    way = self.logp[i] + beta[e]
                    into[i] += math.exp(alpha[s] + way - alpha[-1]) * count
                    beta[s] = np.logaddexp(beta[s], way)
        return float(alpha[-1])


def start_lattice(scores: list[tuple[bytes, float]], words_per_end: float) -> Lattice:
    weights = np.array([w for _, w in scores])
    end = -math.log1p(3.0 * max(words_per_end, 0.01))
    weights = weights - np.logaddexp.reduce(weights) + math.log1p(-math.exp(end))
    return Lattice([p for p, _ in scores], weights, end)


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray | None, list[bytes] | None]]:
    """Words with a blank in front, in groups of one length: row numbers and a matrix of bytes, or the bytes if long."""
    words = list(as_bytes(column))
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    for size in np.unique(sizes):
        lo, hi = np.searchsorted(sizes[order], [size, size + 1])
        for at in range(lo, hi, GROUP):
            rows = order[at : min(hi, at + GROUP)]
            chosen = [b" " + words[i] for i in rows]
            if size >= LONG_WORD:
                yield rows, None, chosen
            else:
                yield rows, np.frombuffer(b"".join(chosen), np.uint8).reshape(len(rows), size + 1), None


def is_training(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


def count_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``word, n_train, n_all`` over all documents; the end of a text is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train: Counter[bytes] = Counter()
        other: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            # One row per word and side; Spark adds the sides up.
            for side, share in ((train, 1), (other, 0)):
                n = np.fromiter(side.values(), np.int64, len(side))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(side), pa.binary()), pa.array(n * share), pa.array(n)], ["word", "n_train", "n_all"]
                )
                side.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                into = train if is_training(doc_id) else other
                into.update(text.lower().split())
                into[b""] += 1
                if len(train) + len(other) > TASK_WORDS:
                    yield from out()
        yield from out()

    return (
        docs.select(id_col, text_col)
        .mapInArrow(count, "word binary, n_train long, n_all long")
        .groupBy("word")
        .agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))
    )


def reestimate(words: DataFrame, lattice: Lattice, scores: list[tuple[bytes, float]], ends: int) -> Lattice:
    """One round of expectation and maximisation over the training words.

    Tasks send one sum per piece, so the driver gets no more than the vocabulary holds.
    """
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        total = np.zeros(len(at.pieces))
        for batch in batches:
            counts = batch.column(1).to_numpy().astype(float)
            for rows, matrix, long in by_length(batch.column(0)):
                if long is None:
                    at.expect(matrix, counts[rows], total)
                else:
                    for i, word in zip(rows, long, strict=True):
                        at.long_word(word, counts[i], total)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

    rows = words.where("n_train > 0 AND length(word) > 0").select("word", "n_train").mapInArrow(expect, "piece long, n double")
    found = rows.groupBy("piece").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(len(scores))
    for r in found:
        n[r["piece"]] = r["n"]
    prior = np.array([w for _, w in scores])
    n += PRIOR * np.exp(prior - np.logaddexp.reduce(prior))
    whole = n.sum() + max(ends, 1)
    return Lattice(lattice.pieces, np.log(n / whole), math.log(max(ends, 1) / whole))


def score_words(words: DataFrame, lattice: Lattice) -> DataFrame:
    """``hash, n_train, n_all, logp``: the log10 marginal probability of each distinct word."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            column = batch.column(0)
            logp = np.full(len(column), at.end)
            hashes = np.zeros(len(column), np.uint64)
            for rows, matrix, long in by_length(column):
                if long is None and matrix.shape[1] == 1:
                    continue
                texts = [row.tobytes() for row in matrix] if long is None else long
                hashes[rows] = _hash_words(b"".join(texts))[0]
                logp[rows] = at.score(matrix) if long is None else [at.long_word(w) for w in long]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), batch.column(1), batch.column(2), pa.array(logp / LN10)],
                ["hash", "n_train", "n_all", "logp"],
            )

    return words.select("word", "n_train", "n_all").mapInArrow(score, "hash long, n_train long, n_all long, logp double")


def _frequent(scored: DataFrame) -> tuple[int, dict[str, np.ndarray]]:
    """The least count of the most frequent words, and their entries; at most ``DICTIONARY`` of them."""
    sizes = scored.groupBy("n_all").agg(F.count("*").alias("n"))
    # Counts of counts are few: a corpus of n tokens has under sqrt(2n) distinct ones.
    top, least = 0, 1 << 62
    for r in sizes.orderBy(F.desc("n_all")).limit(DICTIONARY).toLocalIterator():
        top += r["n"]
        if top > DICTIONARY:
            break
        least = r["n_all"]
    rows = scored.where(F.col("n_all") >= least).toArrow()
    table = {c: rows.column(c).to_numpy() for c in ("hash", "n_train", "logp")}
    order = np.argsort(table["hash"])
    return least, {c: v[order] for c, v in table.items()}


def score_documents(
    docs: DataFrame, model: str, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    Documents whose id has crc32 remainder 2 by 7 are held out of learning; a null id counts as
    the empty string. Words are runs of characters other than blank and ``\\t`` to ``\\r``, A-Z taken
    as a-z; each text has one end more, and a null or empty text nothing else. ``base_score`` is the
    add-one word model, ``score`` the subword lattice; both are log10 probabilities of the whole
    text. Rows that repeat are counted and scored as often as they occur; other columns are ignored;
    an empty table gives no rows. Texts are read whole, in parts if long.
    """
    scores = piece_scores(model)
    words = materialise(count_words(docs, id_col, text_col), "word-counts")
    facts = words.agg(
        F.sum("n_train").alias("n"),
        F.sum(F.when(F.length("word") == 0, F.col("n_train"))).alias("ends"),
        F.count(F.when(F.col("n_train") > 0, 1)).alias("v"),
    ).first()
    tokens, ends, distinct = facts["n"] or 0, facts["ends"] or 0, facts["v"]
    lattice = start_lattice(scores, (tokens - ends) / max(ends, 1))
    for _ in range(rounds):
        lattice = reestimate(words, lattice, scores, ends)
    scored = materialise(score_words(words.where("length(word) > 0"), lattice), "word-scores")
    least, dictionary = _frequent(scored)
    space = float(tokens + distinct + 1)
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)
    end_logp, end_base = lattice.end / LN10, math.log10((ends + 1) / space)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        known = at["hash"]
        table = np.column_stack([at["n_train"] > 0, np.log10((at["n_train"] + 1) / space), at["logp"]]).astype(float)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            numbers, rare_hashes, rare_counts, sizes = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
            for hashes in word_hashes(as_bytes(batch.column(1))):
                own = hashes.view(np.int64)
                if len(known):
                    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    hit = known[place] == own
                else:
                    place, hit = np.zeros(0, np.int64), np.zeros(len(own), bool)
                sums = table[place[hit]].sum(axis=0) if len(known) else np.zeros(3)
                other, n = np.unique(own[~hit], return_counts=True)
                rare_hashes.append(other)
                rare_counts.append(n)
                sizes.append(len(other))
                numbers.append((len(own) + 1, int(sums[0]) + (ends > 0), sums[1] + end_base, sums[2] + end_logp))
            columns = list(zip(*numbers, strict=True)) if numbers else [()] * 4
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(rare_hashes)), pa.array(np.concatenate(rare_counts))], ["hash", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([not is_training(i) for i in ids], pa.bool_()),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.float64()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pairs),
                ],
                [id_col, "held_out", "n_tokens", "n_known", "base_score", "score", "rest"],
            )

    more = T._parse_datatype_string(
        "held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<struct<hash: long, n: long>>"
    ).fields
    found = docs.select(id_col, text_col).mapInArrow(look_up, schema_of(docs.select(id_col), *[(f.name, f.dataType) for f in more]))
    found = materialise(found.withColumn("_row", F.monotonically_increasing_id()), "looked-up")
    rare = scored.where(F.col("n_all") < least).select("hash", "n_train", "logp")
    sums = (
        found.select("_row", F.inline("rest"))
        .join(rare, "hash")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("n_train") > 0, F.col("n"))).alias("k"),
            F.sum(F.col("n") * F.log10((F.col("n_train") + 1) / F.lit(space))).alias("b"),
            F.sum(F.col("n") * F.col("logp")).alias("s"),
        )
    )
    return found.drop("rest").join(sums, "_row", "left").select(
        id_col,
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"),
    )
