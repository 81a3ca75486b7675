"""Each operator against brute force on small tables with every awkward case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skyframe.llm import (
    components,
    decontaminate,
    lattice_lm,
    line_dedup,
    near_dedup,
    packing,
    pii,
    pii_labelled,
    quality,
    queries,
    repeats,
    token_counts,
    warc,
)
from skyframe.llm.words import shingles, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHES = "id text_hash key n_words kept hits items spans marks row component rank length start block word hash gone edge task first _row any".split()


def words(rng, n, of=400):
    return " ".join(f"w{int(of * rng.random() ** 2)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empties, one very long text, copies, near copies, repeated rows, ids that repeat."""
    rng = random.Random(5)
    out = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", None, 4), (None, words(rng, 80), "en", "b", None)]
    for i in range(3, 60):
        out.append((i, ". ".join(words(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 8))), rng.choice(["en", "de", None]), f"s{i % 7}", 9))
    base = words(rng, 300, 10**6)
    for i in range(60, 90):
        parts = base.split()
        for _ in range(i % 4):
            parts[rng.randrange(len(parts))] = f"new{i}"
        out.append((i, " ".join(parts), "en", "hot", 1))
    out += [(i, "The same short text\nin two lines", "en", f"s{i % 12}", 1) for i in range(90, 120)]
    out += [(i, f"Own line {i} of its own\nAll rights reserved.\n\nmore é{i} ünd", "en", f"s{i % 15}", 1) for i in range(120, 150)]
    out += [(200, "Ä ß 漢字 🙂 " * 5, "de", "s1", 1), (201, words(rng, 40_000), "en", "hot", 1), (202, "x" * 30_000, "en", "s2", 1), (203, "ab" * 400, "en", "s2", 1)]
    out += [out[10], out[10], (12, "another text under an id that repeats", "en", "s3", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crowded(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def as_counter(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# --- token counts ---------------------------------------------------------------------------


def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_token_counts(docs, rows, empty):
    p = processor()
    want = Counter((i, len((t or "").encode()), len(p.encode(t or ""))) for i, t, *_ in rows)
    model = public_tokenizers.path("piece_bpe_32k.model")
    got = token_counts.token_counts(crowded(docs), model)
    assert as_counter(got, "doc_id", "n_bytes", "n_tokens") == want
    assert token_counts.token_counts(empty, model).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 17])
def test_cuts_keep_the_count(size):
    p = processor()
    assert token_counts.can_cut(p)
    rng = random.Random(size)
    for _ in range(200):
        text = "".join(rng.choice(["a", "the", " ", "  ", "\n", "▁", "é", ".", "<s>", "漢"]) for _ in range(rng.randint(0, 60)))
        pieces = list(token_counts.cut_text(text, size))
        assert " ".join(pieces) == text
        assert sum(len(x) for x in p.encode(pieces)) == len(p.encode(text)), repr(text)


# --- packing --------------------------------------------------------------------------------


def check_packing(found, size):
    whole, fill = defaultdict(list), defaultdict(list)
    for r in found:
        whole[r["doc_id"], r["doc_tokens"], r["start"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return sum(n for spans in fill.values() for _, n in spans) / (len(fill) * size)


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 128):
            piece = ids[at : at + 128]
            want[i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    got = packing.pack_documents(crowded(docs), queries.PACK_FILES, 128)
    assert as_counter(got, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == want
    assert check_packing(got.collect(), 128) > 0.98
    assert packing.pack_documents(empty, queries.PACK_FILES, 128).count() == 0


def test_ids_are_those_of_the_file():
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing.encoder(*queries.PACK_FILES)
    rng = random.Random(1)
    texts = ["", "<|endoftext|>", "a <|endoftext|> b", "x" * 50_000, " " * 50_000, "\n" * 9 + "a", "don't  can't", "١٢٣ ½ ²"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0xD7FF), rng.randrange(0x10000, 0x1FFFF)])) for _ in range(50)) for _ in range(300)]
    for t in texts:
        assert fast(t).tolist() == slow.encode(t, add_special_tokens=False).ids


def test_long_runs_of_white_space(spark):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    runs = [c * 2_000_000 for c in (" ", "\t", "\n")] + [" " * (packing.LONG_SPACE - 1), " " * packing.LONG_SPACE]
    texts = [before + run + after for run in runs for before, after in (("", ""), ("", "w"), ("a b", "\nc"))]
    fast = packing.encoder(*queries.PACK_FILES)
    for t in texts:
        assert fast(t).tolist() == slow.encode(t, add_special_tokens=False).ids
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:6])], "doc_id long, text string").repartition(3)
    whole = packing.pack_documents(df, queries.PACK_FILES).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("of"))
    assert all(r["n"] == r["of"] == len(slow.encode(texts[r["doc_id"]], add_special_tokens=False).ids) + 1 for r in whole.collect())


def test_patterns_place_every_length_once():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.choice([8, 16, 100])
        histogram = {rng.randint(1, size): rng.randint(1, 500) for _ in range(rng.randint(1, 12))}
        patterns = packing.shortest_pack_first(histogram, size)
        used = Counter()
        for count, pattern in patterns:
            assert sum(pattern) <= size and count > 0
            for n in pattern:
                used[n] += count
        assert used == Counter(histogram)
        assert len(patterns) <= 3 * len(histogram)


# --- quality --------------------------------------------------------------------------------


def measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_measures(docs, rows, empty):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = quality.quality_verdicts(crowded(docs))
    assert as_counter(judged, *names) == Counter((i, *measures(t)) for i, t, *_ in rows)
    assert judged.where("base_failed AND kept").count() == 0
    assert judged.where("kept IS NULL").count() == 0
    assert {c for c in CLASHES if c not in quality.ADDED} <= set(judged.columns)
    assert quality.quality_verdicts(empty).count() == 0
    assert quality.quality_verdicts(docs.where("doc_id < 3")).where("kept").count() == 0


def test_thresholds_follow_the_group(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, 80, 10**9), "en", "plain", 1) for i in range(150)]
    rows += [(i, words(rng, 60, 10**9) + " ###" * 20, "en", "code", 1) for i in range(150, 300)]
    rows += [(300, words(rng, 60, 10**9) + " ###" * 20, "en", "plain", 1), (301, words(rng, 80, 10**9), None, "rare", 1)]
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not kept[300] and kept[301]
    assert all(kept[i] for i in range(300))


def test_limits_follow_the_dirt_of_a_source(spark):
    """Each learnt measure: more of it in one source raises the limit there, and hardly elsewhere."""
    rng = random.Random(9)

    def text(symbols, lines, again):
        own = [words(rng, 12, 10**9) for _ in range(10)]
        own[1 : 1 + lines] = [own[0]] * lines
        return "\n".join(own) + " ###" * symbols + " again and again and" * again

    def limits(times):
        rows = [(i, text(0, 0, 0), "en", "plain", 1) for i in range(300)]
        rows += [(i, text(i % 4 * 5 * times, 0, 0), "en", "symbol_share", 1) for i in range(300, 600)]
        rows += [(i, text(0, i % 2 * times, 0), "en", "repeat_line_share", 1) for i in range(600, 900)]
        rows += [(i, text(0, 0, i % 12 // 11 * times), "en", "repeat_word_share", 1) for i in range(900, 1200)]
        measured = quality.with_measures(spark.createDataFrame(rows, SCHEMA)).drop("text")
        return {r["source"]: r.asDict() for r in quality.fences(measured, ["source"]).collect()}

    once, twice = limits(2), limits(4)
    for name in ("symbol_share", "repeat_line_share", "repeat_word_share"):
        least, most = once[name][f"{name}_most"], twice[name][f"{name}_most"]
        assert most > 1.2 * least, name
        assert twice["plain"][f"{name}_most"] < most, name


def test_limits_move_smoothly_with_the_size_of_a_group(spark):
    rng = random.Random(10)
    # So many that the quantiles of all rows stay where they are.
    plain = [(i, words(rng, 80, 10**9), "en", "plain", 1) for i in range(2000)]
    found = []
    for n in (10, 99, 100, 101):
        rows = plain + [(i, words(rng, 60, 10**9) + " ###" * 20, "en", "code", 1) for i in range(n)]
        measured = quality.with_measures(spark.createDataFrame(rows, SCHEMA)).drop("text")
        found.append(quality.fences(measured, ["source"]).where("source = 'code'").first()["symbol_share_most"])
    # The texts are drawn anew each time, so the limits differ a little by themselves.
    assert found[0] < min(found[1:]) and max(found[1:]) - min(found[1:]) < 0.1 * found[2]


# --- lines ----------------------------------------------------------------------------------


def test_line_dedup(docs, rows, empty):
    sites, first = defaultdict(set), {}
    for i, text, _, site, _ in rows:
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                sites[line].add(site)
                first[line] = min((i is None, i or 0), first.get(line, (True, 1 << 60)))
    want = Counter()
    for i, text, _, _, n in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(sites[x] - {None}) < 10 or first[x] == (i is None, i or 0)]
        want[i, None if text is None else "\n".join(left), n, len(lines), len(lines) - len(left)] += 1
    got = line_dedup.remove_spread_lines(crowded(docs))
    assert as_counter(got, "doc_id", "text", "n_chars", "n_lines", "n_removed") == want
    assert sum(r["n_removed"] for r in got.collect()) > 50
    assert set(got.columns) == {*crowded(docs).columns, "n_lines", "n_removed"}
    assert line_dedup.remove_spread_lines(empty).count() == 0


def test_lines_near_the_threshold_are_counted_exactly(spark):
    rows = [(i, f"line of {k} sites", "en", f"site {i}", 0) for k in range(5, 16) for i in range(k)]
    rows = [(n, t, lang, s, c) for n, (_, t, lang, s, c) in enumerate(rows)]
    places = line_dedup.line_places(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source")
    assert line_dedup.spread_lines(places).count() == 6


# --- near duplicates ------------------------------------------------------------------------


def groups_by_hand(rows, k, share=80):
    sets = defaultdict(list)
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        n = min(k, len(w))
        if i is not None and n:
            sets[i].append({tuple(w[j : j + n]) for j in range(len(w) - n + 1)})
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(100 * len(x & y) >= share * len(x | y) for x in sets[a] for y in sets[b]):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, rows, empty, k):
    small = [r for r in rows if r[0] != 201]
    want = groups_by_hand(small, k)
    got = near_dedup.near_duplicates(crowded(docs).where("doc_id IS NULL OR doc_id <> 201"), k).collect()
    assert len(got) == len(small)
    assert all(r["component"] == want.get(r["id"], r["id"]) for r in got)
    kept = near_dedup.drop_near_duplicates(crowded(docs), k)
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} >= set(want.values()) | {0, 1, 2, None}
    assert set(kept.columns) == set(crowded(docs).columns)
    assert near_dedup.drop_near_duplicates(empty, k).count() == 0


def test_ids_that_repeat_tie_their_texts(spark):
    """An id is one document with the links of all its texts, also where others share them; of equal rows one stays."""
    rng = random.Random(13)
    a, b, c, d, e = (words(rng, 60, 10**9) for _ in range(5))
    held = [(5, a), (5, b), (3, b), (9, c), (9, d), (7, c), (8, d + " end"), (8, d + " end"), (6, e), (6, e), (None, a), (None, a), (None, e), (1, ""), (1, None), (2, None), (2, None)]
    rows = [(i, t, "en", f"s{n}", 0) for n, (i, t) in enumerate(held)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = groups_by_hand(rows, 5)
    assert want[5] == 3 and want[9] == want[8] == 7
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows) and all(r["component"] == want.get(r["id"], r["id"]) for r in got)
    kept = near_dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    stays = {(i, t) for i, t in held if want.get(i, i) == i}
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(stays)
    assert set(map(tuple, kept.collect())) <= set(rows)


def test_bands_follow_from_the_share():
    assert [near_dedup.rows_for(s) for s in (100, 80, 50, 8)] == [near_dedup.ROWS, near_dedup.ROWS, 2, 1]
    for share in range(8, 101):
        rows = near_dedup.rows_for(share)
        assert (1 - (share / 100) ** rows) ** (near_dedup.HASHES // rows) <= near_dedup.MISSED
    assert near_dedup.least_agreement(80) == near_dedup.least_agreement(95) == 126 > near_dedup.least_agreement(50) > 50
    for share in (7, 0):
        with pytest.raises(ValueError):
            near_dedup.rows_for(share)


def test_links_of_a_smaller_share(spark):
    """Pairs that have between 50 and 63 percent in common, far from the registered 80, among them of unlike sizes."""
    rng = random.Random(14)
    rows = []
    for n in range(0, 180, 3):
        text = words(rng, 130, 10**9).split()
        keep = rng.randint(88, 100)
        rows.append((n, " ".join(text), "en", "s", 0))
        rows.append((n + 1, " ".join(text[:keep] + words(rng, 130 - keep, 10**9).split()), "en", "s", 0))
        rows.append((n + 2, " ".join(text[: rng.randint(70, 80)]), "en", "s", 0))
    want = groups_by_hand(rows, 4, 50)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4, 50).collect()
    assert all(r["component"] == want[r["id"]] for r in got)
    assert 60 < sum(want[i] != i for i in want) <= 120


def test_links_that_no_pivot_shows(spark, monkeypatch):
    """Chains of links, and buckets of many blocks: only the second search can close them."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = random.Random(8)
    rows, n = [], 0
    for _ in range(6):
        text = [f"t{rng.randrange(10**9)}" for _ in range(100)]
        for _ in range(14):
            rows.append((n, " ".join(text), "en", "s", 0))
            n += 1
            at = rng.randrange(95)
            text[at : at + 2] = [f"u{rng.randrange(10**9)}", f"u{rng.randrange(10**9)}"]
    rng.shuffle(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4).collect()
    want = groups_by_hand(rows, 4)
    assert all(r["component"] == want[r["id"]] for r in got)


def test_words_that_a_polynomial_confuses(spark):
    """Two words of 1,024 letters that agree in every polynomial modulo 2^64 with an odd factor."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    two = "".join("ba"[i.bit_count() % 2] for i in range(1024))
    hashes = next(word_hashes(iter([f"{one} {two} {one}".encode()])))
    assert hashes[0] == hashes[2] != hashes[1]
    rows = [(1, one, "en", "s", 0), (2, two, "en", "s", 0), (3, one, "en", "s", 0)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 4).collect()
    assert {r["id"]: r["component"] for r in got} == {1: 1, 2: 2, 3: 1}


def test_word_hashes_are_distinct():
    """All short words over a few letters, and words that differ in one place of any block of eight bytes."""
    from itertools import product

    some = ["".join(p) for n in range(1, 8) for p in product("abc0", repeat=n)]
    some += ["x" * n for n in range(1, 200)] + ["x" * i + "y" + "x" * (99 - i) for i in range(100)]
    some += ["q" * i + "z" + "q" * (63 - i) for i in range(64)]
    some = sorted(set(some))
    hashes = next(word_hashes(iter([" ".join(some).encode()])))
    assert len(hashes) == len(some) == len(set(hashes.tolist()))
    alone = [next(word_hashes(iter([w.encode()])))[0] for w in some[::97]]
    assert alone == hashes[::97].tolist()


def test_word_hashes_do_not_depend_on_neighbours(monkeypatch):
    from skyframe.llm import words as module

    rng = random.Random(4)
    texts = [words(rng, rng.randint(0, 50)).encode() for _ in range(50)] + [b"", b" ", b"A b\x0bC", b"x" * 900]
    plain = [x.tolist() for x in word_hashes(iter(texts))]
    monkeypatch.setattr(module, "CHUNK", 64)
    assert [x.tolist() for x in word_hashes(iter(texts))] == plain
    assert [len(x) for x in plain] == [len(t.split()) for t in texts]
    assert next(word_hashes(iter([b"aB Cd"]))).tolist() == next(word_hashes(iter([b"ab\tcD"]))).tolist()
    assert len(shingles(next(word_hashes(iter([b"a b c a b c a"]))), 3)) == 3


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (None, 3)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    root = {}
    for u, v in edges:
        if u is not None and u != v:
            a, b = ({x for x in s} for s in ({u}, {v}))
            for s in list(root.values()):
                if u in s:
                    a = s
                if v in s:
                    b = s
            both = a | b
            for x in both:
                root[x] = both
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: min(s) for x, s in root.items()}


# --- repeated passages ----------------------------------------------------------------------


def spans_by_hand(rows, length=100):
    first = {}
    for i, text in rows:
        for at in range(len(text) - length + 1):
            first[text[at : at + length]] = min(first.get(text[at : at + length], ((True, 1 << 60), 0)), (i, at))
    out = []
    for i, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for at in range(len(text) - length + 1):
            if first[text[at : at + length]] < (i, at):
                gone[at : at + length] = True
        kept = bytes(b for b, g in zip(text, gone, strict=False) if not g)
        out.append((len(text), int(gone.sum()), int(np.sum(np.diff(gone.astype(int), prepend=0) == 1)), hashlib.sha256(kept).hexdigest()))
    return out


def keyed(rows):
    return [((False, 0) if i is None else (True, i), (t or "").encode()) for i, t, *_ in rows]


def check_repeats(spark, rows):
    want = Counter((i, *x) for (i, *_), x in zip(rows, spans_by_hand(keyed(rows)), strict=True))
    df = crowded(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_repeats(spark, rows, empty):
    rows = [(i, t if i != 201 else t[:9000], *rest) for i, t, *rest in rows]
    check_repeats(spark, rows)
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_of_one_text_and_cut_stretches(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    rng = random.Random(9)
    parts = ["".join(rng.choice("abc ") for _ in range(rng.randint(60, 300))) for _ in range(8)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 9))), "en", "s", 0) for i in range(40)]
    rows += [(50, "a" * 2500, "en", "s", 0), (51, "ab" * 700, "en", "s", 0), (52, "é" * 400, "en", "s", 0)]
    check_repeats(spark, rows)


def test_first_rows_across_tasks(spark):
    """Groups larger than a task's share are marked once."""
    rows = spark.range(4000).select(
        (F.col("id") % 3).alias("a"), F.lit(1).cast("long").alias("b"), F.col("id"), F.lit(0).alias("at")
    ).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = repeats._firsts(rows, ["a", "b"], "at", "test").where("first").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["id"] for r in got) == [0, 1, 2]


# --- decontamination ------------------------------------------------------------------------


def contamination_by_hand(text, tests, k=13):
    own = decontaminate.words_of((text or "").encode())
    hit, items = set(), set()
    for name, t in tests:
        w = decontaminate.words_of((t or "").encode())
        n = min(k, len(w))
        parts = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in parts:
                hit |= set(range(i, i + n))
                items.add(str(name))
    return len(own), len(hit), tuple(sorted(items)), len(hit) > 0 and 20 * len(hit) >= len(own)


@pytest.fixture(scope="module")
def tests_table(rows):
    base = next(t for i, t, *_ in rows if i == 60)
    long = next(t for i, t, *_ in rows if i == 201)
    b = base.split()
    return [
        (1, " ".join(b[10:40])), (2, "; ".join(x.upper() for x in b[100:113])), (3, "漢字"), (4, None), (5, ""), (6, " ".join(long.split()[500:560])),
        (7, " ".join(b[10:40])), (8, "same short text"), (None, "all RIGHTS reserved"), (10, "of " * 30), (10, "rights"), (11, " ".join(b[:12])),
    ]


@pytest.mark.parametrize("block", [1 << 24, 150])
def test_contamination(spark, docs, rows, empty, tests_table, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 3000)
    tests = spark.createDataFrame(tests_table, "item_id long, text string").withColumn("hits", F.lit(1))
    want = Counter((i, *contamination_by_hand(t, tests_table)) for i, t, *_ in rows)
    got = decontaminate.contamination(crowded(docs), tests).select(
        "doc_id", "n_words", decontaminate.n_hit().alias("h"), "items", decontaminate.contaminated().alias("c")
    )
    assert Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in got.collect()) == want
    assert decontaminate.contamination(empty, tests).count() == 0
    assert decontaminate.contamination(docs, tests.where("false")).where("size(hits) > 0").count() == 0


def test_one_block_is_held_at_a_time(spark, docs, rows, tests_table, monkeypatch):
    """Of a test set of many blocks, each is gone before the next is built."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 150)
    context, held, most = spark.sparkContext, set(), []
    broadcast = context.broadcast

    def counted(value):
        own = broadcast(value)
        destroy = own.destroy
        held.add(id(own))
        most.append(len(held))

        def gone(*args):
            held.discard(id(own))
            destroy(*args)

        own.destroy = gone
        return own

    monkeypatch.setattr(context, "broadcast", counted)
    tests = spark.createDataFrame(tests_table, "item_id long, text string")
    got = decontaminate.contamination(docs, tests).select("doc_id", "n_words", decontaminate.n_hit().alias("h"), "items", decontaminate.contaminated().alias("c"))
    want = Counter((i, *contamination_by_hand(t, tests_table)) for i, t, *_ in rows)
    assert Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in got.collect()) == want
    assert len(most) > 5 and max(most) == 1
    most.clear(), held.clear()
    blocks = {(r["item_id"], r["item_start"]): r["n_shared"] for r in decontaminate.longest_matches(docs, tests.where("item_id <> 10")).collect()}
    assert len(most) > 5 and max(most) == 1
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1 << 24)
    whole = {(r["item_id"], r["item_start"]): r["n_shared"] for r in decontaminate.longest_matches(docs, tests.where("item_id <> 10")).collect()}
    assert blocks == whole


def test_words_of():
    fold = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for text in ["A b-C_d 9é", "漢字 x\x80y", "", "Z" * 5, "a b", "\x7fq"]:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        assert [w.decode() for w in decontaminate.words_of(text.encode())] == fold.findall(low)


def test_longest_matches(spark, docs, rows, tests_table):
    tests = spark.createDataFrame(tests_table, "item_id long, text string").where("item_id IN (1, 2, 6)")
    got = {(r["item_id"], r["item_start"]): r for r in decontaminate.longest_matches(docs, tests).collect()}
    texts = [(i, decontaminate.words_of((t or "").encode())) for i, t, *_ in rows]
    for name, t in tests_table:
        if name not in (1, 2, 6):
            continue
        w = decontaminate.words_of(t.encode())
        for at in range(len(w)):
            tail = w[at : at + decontaminate.DEPTH]
            best = max((next((k for k in range(len(tail)) if own[i : i + k + 1] != tail[: k + 1]), len(tail)) for _, own in texts for i in range(len(own)) if own[i] == tail[0]), default=0)
            if best >= decontaminate.WINDOW:
                r = got[str(name), at]
                assert r["n_words"] == best
                assert any(i == r["doc_id"] and own[r["doc_start"] : r["doc_start"] + best] == tail[:best] for i, own in texts)
            else:
                assert (str(name), at) not in got


def longest_by_hand(texts, items, least):
    """The uncut longest match of every suffix: (words, smallest document, smallest place), nulls first."""
    out = {}
    for name, t in items:
        w = decontaminate.words_of(t.encode())
        for at in range(len(w)):
            best = []
            for i, own in texts:
                for p in range(len(own)):
                    n = 0
                    while at + n < len(w) and p + n < len(own) and own[p + n] == w[at + n]:
                        n += 1
                    best.append((-n, i is not None, i or 0, p))
            n, known, i, p = min(best)
            if -n >= least:
                out[str(name), at] = (-n, i if known else None, p)
    return out


@pytest.mark.parametrize(("least", "shard"), [(13, 4 << 20), (13, 700), (2, 4 << 20), (40, 4 << 20)])
def test_longest_matches_are_not_cut(spark, least, shard, monkeypatch):
    """A passage of several hundred words beside decoys that share its first words, and ties."""
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    monkeypatch.setattr(decontaminate, "COMPARED", 50)
    rng = random.Random(12)
    long = words(rng, 230, 10**6).split()
    items = [(1, " ".join(long)), (2, "x y " + "of " * 70), (3, " ".join(long[50:114])), (4, "")]
    held = [
        (9, " ".join([*words(rng, 9).split(), *long[:32], *words(rng, 9).split()])), (8, " ".join(["a", *long[:200], "b"])),
        (7, " ".join(["c", "d", *long[:200], "e"])), (7, " ".join(["c", *long[:200], "e"])), (6, " ".join([*long[:33], "z", *long[20:97]])),
        (5, "of " * 50), (4, "y " + "of " * 40), (3, " ".join(long[100:])), (None, " ".join(["q", *long[100:]])), (2, None), (1, ""),
    ]
    docs = spark.createDataFrame(held, "doc_id long, text string").coalesce(1)
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = longest_by_hand([(i, decontaminate.words_of((t or "").encode())) for i, t in held], items, least)
    got = decontaminate.longest_matches(docs, tests, least).collect()
    assert {(r["item_id"], r["item_start"]): (r["n_shared"], r["doc_id"], r["doc_start"]) for r in got} == want
    assert all(r["n_words"] == min(r["n_shared"], max(decontaminate.DEPTH, least)) for r in got)
    assert len(got) == len(want) and want["1", 0] == (200, 7, 1)


# --- archives -------------------------------------------------------------------------------


def pages_by_hand(pages, least=0):
    first = {}
    for i, _, html in pages:
        p = (html or "").encode()
        if i is not None:
            first[p] = min(i, first.get(p, i))
    out = Counter()
    for i, _, html in pages:
        p = (html or "").encode()
        f = first.get(p) if len(p) >= least else None
        revisit = f is not None and f != i
        out[i, len(p), warc.base32_sha1(p), "revisit" if revisit else "response", f if revisit else None] += 1
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, least, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    monkeypatch.setattr(warc, "DIRECTORY_KEY", 20)
    rng = random.Random(3)
    pages = [(i, f"http://www.Site{i % 5}.example.com:80/p?q={i % 9}#frag", f"<p>{'é' * rng.randint(0, 200)}</p>") for i in range(60)]
    pages += [(100 + i, "https://hot.example.org/one", "<b>same</b>") for i in range(40)]
    pages += [(200, None, None), (201, "not a url \r\n x", ""), (202, "", "a"), (203, "http://[::1]:8080/x y", "z" * 50_000), (None, "http://a.b/", "<b>same</b>")]
    pages += [pages[7], (8, "http://other.example.com", "again")]
    df = crowded(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3))
    got = warc.archive_and_read(df, with_payload=True) if least == 0 else None
    if got is not None:
        assert as_counter(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == pages_by_hand(pages)
        texts = Counter((i, (h or "").encode()) for i, _, h in pages)
        for r in got.where("record_type = 'response'").collect():
            assert (r["page_id"], bytes(r["payload"])) in texts
    else:
        from skyframe.session import new_folder

        folder = new_folder(spark, "archives")
        found = warc.read_records(warc.write_archives(df, folder, least_bytes=least), folder, with_payload=False)
        assert as_counter(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == pages_by_hand(pages, least)


def test_reading_tasks_follow_the_bytes_that_captures_name(spark, monkeypatch):
    from skyframe.session import materialise, new_folder

    rng = random.Random(5)
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.example.com/{i}", rng.randbytes(1000).hex()) for i in range(400)], "page_id long, url string, html string")
    folder = new_folder(spark, "archives")
    captures = materialise(warc.write_archives(pages, folder), "captures")
    size = captures.agg({"length": "sum"}).first()[0]
    for a_task in (20_000, 100_000):
        monkeypatch.setattr(warc, "TASK_BYTES", a_task)
        found = warc.read_records(captures, folder, with_payload=False)
        assert size / a_task * 0.7 <= found.rdd.getNumPartitions() <= size / a_task + 1
        assert found.count() == 400


def test_records_name_what_they_repeat(spark):
    from datetime import datetime

    from skyframe.session import new_folder

    pages = [(2, "http://b.example/x y", "same", datetime(2021, 3, 4, 5, 6, 7)), (1, "http://a.example/", "same", datetime(2020, 1, 2)), (None, "http://n.example/", "same", datetime(2019, 1, 1)), (3, None, "other", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, at timestamp")
    folder = new_folder(spark, "archives")
    captures = warc.write_archives(df, folder, date_col="at").collect()
    found = {}
    for c in captures:
        with open(f"{folder.removeprefix('file:')}/{c['file']}", "rb") as f:
            f.seek(c["offset"])
            record = warc.parse_record(zlib.decompress(f.read(c["length"]), 31))
        found[c["page_id"]] = record
    names = ["WARC-Date", "WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date"]
    first = ["<urn:page:1>", "http://a.example/", "2020-01-02T00:00:00Z"]
    assert [found[2].get(n) for n in names] == ["2021-03-04T05:06:07Z", *first]
    assert [found[None].get(n) for n in names] == ["2019-01-01T00:00:00Z", *first]
    assert [found[1].get(n) for n in names] == ["2020-01-02T00:00:00Z", None, None, None]
    assert found[3]["WARC-Date"][:2] == "20" and warc.write_archives(df, new_folder(spark, "archives")).count() == 4


def test_archives_of_nothing(spark):
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_lookup_finds_only_what_is_there(spark):
    from skyframe.session import new_folder

    pages = spark.createDataFrame([(i, f"http://h{i % 3}.example.com/{i}", "x") for i in range(50)], "page_id long, url string, html string")
    index = warc.build_index(warc.write_archives(pages, new_folder(spark, "archives")), new_folder(spark, "index"))
    keys = spark.createDataFrame([(warc.capture_key("http://h1.example.com/4", 4),), ("com,example,h1)/4",), ("zzz 1",), (None,)], "key string")
    assert [r["page_id"] for r in warc.lookup(keys, index).collect()] == [4]


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://blog.Example.com/a/b?x=1#top", "com,example,blog)/a/b?x=1"),
        ("https://user:pw@example.com:443", "com,example)/"),
        ("http://example.com:8080/", "com,example:8080)/"),
        ("mailto:x", "mailto:x"),
        ("a b", "a%20b"),
        (None, ""),
    ],
)
def test_url_keys(url, key):
    assert warc.url_key(url) == key


# --- personal data --------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_patterns():
    rng = random.Random(2)
    atoms = ["a", "b.c", "@", "@x", ".com", "-", "_", "+", "%", "1", "255", "256", "0001", ".", " ", "4111111111111111", "+49 ", "(", ")", "é", "\n", "12 34-56"]
    for _ in range(4000):
        text = "".join(rng.choice(atoms) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == base_by_hand(text), repr(text)
    assert len(pii.base_spans("a" * 200_000 + "1" * 200_000)) == 0


@pytest.fixture(scope="module")
def field(spark):
    return pii.train_from(pii_labelled.default_labelled(spark))


def test_personal_data(spark, docs, rows, empty, field):
    more = [(500, "call (617) 555-0199 or mail bob at corp dot example dot com, or jo@x.org 1.2.3.4 é", "en", "s", 0)]
    df = crowded(docs.unionByName(spark.createDataFrame(more, SCHEMA)))
    got = pii.find_personal_data(df, field)
    want = Counter((i, pii.written(base_by_hand(t or ""))) for i, t, *_ in [*rows, *more])
    assert as_counter(got.select("doc_id", pii.written_spans(F.col("base")).alias("b")), "doc_id", "b") == want
    added = got.where("doc_id = 500").first()["added"]
    assert [(s["kind"], more[0][1][s["start"] : s["end"]]) for s in added] == [("phone", "(617) 555-0199"), ("email", "bob at corp dot example dot com")] or {s["kind"] for s in added} == {"phone", "email"}
    assert pii.find_personal_data(empty, field).count() == 0


def test_spelled_at_before_a_literal_dot(spark, field):
    """Addresses without a digit, an ``@`` or a ``dot`` near them; none of these lines is a marked one."""
    marked = [
        "Please ask [[email|jane (at) example.org]] about it.",
        "You can write to [[email|k.tanaka [at] example.com]] for details.",
        "To [[email|the.webmaster (at) www.my-long-host-name.dept.example.co.uk]] as soon as you can.",
        "My email: [[email|sam_hill at mail.example.com]], thanks",
        "E-mail: [[email|j.r.r.smith-jones(at)lists.example.org]]",
        "You can read more at example.org about it.",
        "Find out more at our site at blog.example.net.",
        "The file is at lib.core.utils in the tree.",
        "He graduated (at last) from school.Then he left.",
        "Follow the news at www.bbc.co.uk",
    ]
    lines = [pii.parse_marked(m) for m in marked]
    docs = spark.createDataFrame([(i, "far off " * 200 + t) for i, (t, _) in enumerate(lines)], "doc_id long, text string")
    for r in pii.find_personal_data(docs, field).collect():
        want = [(k, a + 1600, b + 1600) for k, a, b in lines[r["doc_id"]][1]]
        assert ([tuple(s) for s in r["added"]], r["base"]) == (want, []), marked[r["doc_id"]]


def test_spelled_at_covers_every_joint():
    text = "see a.b_c-d (AT) e-f.g.h-i.j k.l"
    assert [text[i] for i in pii.spelled_at(text)] == list(". _ - A - . . - .".split())
    for text in ("look at the dot.com", "at", "at home", "x.y at", "that example.org", "cat.at x y.z"):
        assert pii.spelled_at(text) == []
    for part in ("at-", "at ", "at.", "(at) ", "a.at.b "):
        n = len(pii.spelled_at(part * 100_000 + "b.c"))
        assert n <= len(part) * 100_000 + 3


def test_viterbi_finds_the_best_path(field):
    rng = np.random.default_rng(0)
    size = len(pii.LABELS)
    batch = [rng.normal(size=(n, size)) * 3 for n in (1, 2, 3, 4)]
    import itertools

    starts = [i for i, name in enumerate(pii.LABELS) if name[0] != "I"]
    for scores, path in zip(batch, field.decode(batch), strict=True):

        def value(p):
            return sum(scores[t, y] for t, y in enumerate(p)) + sum(field.step[a, b] for a, b in zip(p, p[1:], strict=False))

        best = max((p for p in itertools.product(range(size), repeat=len(scores)) if p[0] in starts), key=value)
        assert math.isclose(value(best), value(path.tolist()))


def test_field_on_held_out_lines():
    lines = [pii.parse_marked(x) for x in pii_labelled.MARKED]
    right = found = wanted = 0
    for part in range(4):
        field = pii.train([x for i, x in enumerate(lines) if i % 4 != part], rounds=150)
        for text, spans in (x for i, x in enumerate(lines) if i % 4 == part):
            got = set()
            for w in pii.windows(text):
                got |= set(pii.read_labels(text, w, field.decode([field.rows(field.features(text, w))])[0]))
            right, found, wanted = right + len(got & set(spans)), found + len(got), wanted + len(spans)
    assert right / wanted > 0.5 and right / found > 0.7


#: Cues, ends and clean lines of which none is in the labelled table; # is a digit, @ a pseudo-word.
OTHER_BEFORE = {
    "email": "replies go to|tell|inbox:|the maintainer|subscribe via|submit it by mail to".split("|"),
    "phone": "front desk|switchboard:|extension|helpline|signal|she answers".split("|"),
    "ip": "subnet|proxy|ssh into|upstream|peer|hop".split("|"),
    "card": "prepaid|mc|billing|the customer gave|refund to".split("|"),
}
OTHER_AFTER = "| first|...| instead|, ok?| whenever you like".split("|")
OTHER_CLEAN = """paragraph #.#.# applies
firmware #.##.##-#### installed
tracking ################## shipped
won ##-##, lost ##-##, tied #
bus ### leaves at ##:##
barcode #############
grid ##.## by ##.##
in the ####s and ####s
measured ###.# ### ###.## and ##
hymn ### and psalm ##
they looked at @.Then they left
posted at @.com/@ by @
flight @ #### to gate ##
a loss of (##.#) and (##.##) million
#### votes to ####
doi ##.####/@.####""".split("\n")


def test_field_on_other_contexts(field):
    """Recall and precision of each kind, base spans included, where no context was seen in training."""
    lines = pii_labelled.varied(1600, seed=1234, before=OTHER_BEFORE, after=OTHER_AFTER, clean=OTHER_CLEAN)
    right, found, wanted = Counter(), Counter(), Counter()
    for text, spans in map(pii.parse_marked, lines):
        got = set(pii.base_spans(text))
        taken = [(a, b) for _, a, b in got]
        for w in pii.windows(text):
            for s in pii.read_labels(text, w, field.decode([field.rows(field.features(text, w))])[0]):
                if not any(a < s[2] and s[1] < b for a, b in taken):
                    got.add(s)
        right.update(k for k, *_ in got & set(spans))
        found.update(k for k, *_ in got)
        wanted.update(k for k, *_ in spans)
    shares = {k: (round(right[k] / wanted[k], 3), round(right[k] / found[k], 3)) for k in pii.KINDS}
    assert all(recall >= 0.9 and precision >= 0.95 for recall, precision in shares.values()), shares


def test_windows_whose_surroundings_meet_are_one():
    for gap in range(40):
        text = "1 " + "word " * gap + "joe (at) example (dot) org and so on " + "far " * 50 + "2"
        first, *rest = [text[w[0][0] : w[-1][1]] for w in pii.windows(text)]
        whole = [w for w in (first, *rest) if "joe (at) example (dot) org" in w]
        # The anchors are "1", and "dot", which is the seventh token behind the gap.
        assert len(whole) == 1 and len(rest) == (1 if gap + 7 <= 2 * pii.REACH else 2), gap
        # Each window holds what lies within the reach of its anchors, and no token twice.
        spans = [s for w in pii.windows(text) for s in w]
        assert spans == sorted(set(spans))


def test_an_address_of_the_field_is_a_whole_one():
    text = "To ann_b (at) x.example dot com, or bo@y.example, or nobody"
    spans = pii.whole_addresses(text, [("email", 6, 40), ("ip", 0, 2)], 0, len(text))
    assert [(k, text[a:b]) for k, a, b in spans] == [("email", "ann_b (at) x.example dot com"), ("email", "bo@y.example"), ("ip", "To")]
    assert pii.whole_addresses("at noon", [("email", 0, 7)], 0, 7) == [("email", 0, 7)]


# --- language model -------------------------------------------------------------------------


def test_lattice_sums_all_segmentations():
    rng = random.Random(7)
    pieces = [(p.encode(), rng.uniform(-6, -1)) for p in [" ", "a", "b", "c", " a", "ab", "bc", "abc", " ab", "ca", "cab", "b" * 60]]
    lattice = lattice_lm.Lattice([p for p, _ in pieces], np.array([w for _, w in pieces]), -2.0)
    weight = dict(pieces)

    def by_hand(text):
        if not text:
            return 1.0, Counter()
        total, expected = 0.0, Counter()
        for p, w in weight.items():
            if text.startswith(p):
                rest, inside = by_hand(text[len(p) :])
                total += math.exp(w) * rest
                for k, v in inside.items():
                    expected[k] += math.exp(w) * v
                expected[p] += math.exp(w) * rest
        return total, expected

    for n in (1, 2, 4, 7):
        texts = [b" " + "".join(rng.choice("abc") for _ in range(n)).encode() for _ in range(20)]
        rows = np.frombuffer(b"".join(texts), np.uint8).reshape(20, n + 1)
        score = lattice.score(rows)
        into = np.zeros(len(pieces))
        lattice.expect(rows, np.ones(20), into)
        long, want = np.zeros(len(pieces)), np.zeros(len(pieces))
        for text, s in zip(texts, score, strict=True):
            total, expected = by_hand(text)
            assert math.isclose(s, math.log(total), rel_tol=1e-9)
            assert math.isclose(lattice.long_word(text, 1.0, long), s, rel_tol=1e-9)
            for p, v in expected.items():
                want[lattice.ids[p]] += v / total
        assert np.allclose(into, want) and np.allclose(long, want)


@pytest.mark.parametrize("size", [1 << 20, 40, 0])
def test_scores(docs, rows, empty, size, monkeypatch):
    monkeypatch.setattr(lattice_lm, "DICTIONARY", size)
    monkeypatch.setattr(lattice_lm, "TASK_WORDS", 50)
    model = public_tokenizers.path("piece_bpe_32k.model")
    counts, tokens = Counter(), []
    for i, text, *_ in rows:
        w = [*(text or "").encode().lower().split(), b""]
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        tokens.append((i, held, w))
        if not held:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    got = defaultdict(list)
    for r in lattice_lm.score_documents(crowded(docs), model, rounds=1).collect():
        got[r["doc_id"], r["n_tokens"]].append(r)
    for i, held, w in tokens:
        r = got[i, len(w)][0]
        base = sum(math.log10(Fraction(counts[x] + 1, n + v + 1)) for x in w)
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held, sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert sum(map(len, got.values())) == len(rows)
    assert lattice_lm.score_documents(empty, model, rounds=1).count() == 0


def segmentations(word, pieces):
    """All ways to write a word in pieces."""
    if not word:
        yield []
    for e in range(1, len(word) + 1):
        if word[:e] in pieces:
            for rest in segmentations(word[e:], pieces):
                yield [word[:e], *rest]


def test_score_is_the_sum_over_all_segmentations(spark):
    """Both rounds of re-estimation and the score of each text, with every segmentation written out."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["The quick fox", "the the THE", "a b\tc\n\x0bd", "größe été", "", None, "re-run 123 runs", "running the runs", "xqzvk", "  the  ", "fox été 9", "unseen zebra"]
    texts = [(i, x) for i, x in enumerate(texts * 2)] + [(3, texts[3]), (None, "the fox")]
    weights = {p: math.exp(w) for p, w in lattice_lm.piece_scores(model)}
    words = {i: [w for w in (x or "").encode().lower().split()] for i, (_, x) in enumerate(texts)}
    training = [n for n, (i, _) in enumerate(texts) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    assert 0 < len(training) < len(texts)
    counts = Counter(w for n in training for w in words[n])
    ends, total = len(training), sum(weights.values())
    end = 1 / (1 + 3 * max(sum(counts.values()) / ends, 0.01))
    chance = {p: w / total * (1 - end) for p, w in weights.items()}
    ways = {w: list(segmentations(b" " + w, weights)) for w in {w for found in words.values() for w in found}}

    def chances(word):
        return [math.prod(chance[p] for p in way) for way in ways[word]]

    for _ in range(2):
        drawn = Counter({p: lattice_lm.PRIOR * w / total for p, w in weights.items()})
        for word, n in counts.items():
            each = chances(word)
            for way, c in zip(ways[word], each, strict=True):
                for p in way:
                    drawn[p] += n * c / sum(each)
        whole = sum(drawn.values()) + ends
        chance, end = {p: n / whole for p, n in drawn.items()}, ends / whole
    want = sorted((str(i), round(sum(math.log10(sum(chances(w))) for w in words[n]) + math.log10(end), 6)) for n, (i, _) in enumerate(texts))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = sorted((str(r["doc_id"]), round(r["score"], 6)) for r in lattice_lm.score_documents(df, model).collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert all(math.isclose(a[1], b[1], rel_tol=1e-6, abs_tol=2e-6) for a, b in zip(got, want, strict=True)), list(zip(got, want, strict=True))


def test_score_does_not_depend_on_the_dictionary(docs, monkeypatch):
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = []
    for size in (1 << 20, 30):
        monkeypatch.setattr(lattice_lm, "DICTIONARY", size)
        found.append(sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lattice_lm.score_documents(docs, model, rounds=1).collect()))
    for a, b in zip(*found, strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9)
