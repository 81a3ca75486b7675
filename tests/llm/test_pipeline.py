"""The pipeline against a brute-force version of each of its stages."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from skyframe.llm import line_dedup, quality
from test_small_ops import check_packing, contamination_by_hand, groups_by_hand, measures, words

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
SIZE = 1024


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    rows = [(i, "\n".join(words(rng, rng.randint(5, 40), 10**6) for _ in range(rng.randint(2, 6))), "en", f"s{i % 14}") for i in range(120)]
    base = words(rng, 150, 10**6)
    for i in range(120, 150):
        parts = base.split()
        for _ in range(i % 3):
            parts[rng.randrange(150)] = f"edit{i}"
        rows.append((i, " ".join(parts) + f"\nAll rights reserved.\nlast line {i}", "en", f"s{i % 14}"))
    rows += [(i, rows[i - 150][1], None, "hot") for i in range(150, 160)]
    rows += [(160, None, "en", "a"), (161, "", "en", "a"), (162, "few words", "en", "a"), (163, words(rng, 60) + " ###" * 40, "en", "s1"), (164, "again and again " * 40, "en", "s2")]
    passage = words(rng, 40, 10**6)
    rows += [(170, words(rng, 100, 10**6) + " " + passage, "en", "s3"), (171, words(rng, 3000, 10**6) + " " + passage, "en", "s4"), (172, words(rng, 6000, 10**6), "de", "s5")]
    return [(*r, len(r[1] or ""), "x") for r in rows], [(1, passage), (2, "short item here"), (3, None)]


@pytest.fixture(scope="module")
def sf_dir(spark, tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(tables[0], DOCUMENTS).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(tables[1], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def quality_by_hand(rows):
    """Base rules, then limits beyond the quantiles of language and source, blended with those of all rows."""
    seen = [(r, measures(r[1])) for r in rows]

    def shares(r, m):
        lines = [x for x in (r[1] or "").split("\n") if x.strip(line_dedup.SPACE)]
        return {"word_length": m[1] / m[0], "symbol_share": m[2] / m[1], "repeat_line_share": m[3] / len(lines), "repeat_word_share": m[4] / m[0]}

    good = [(r, shares(r, m)) for r, m in seen if not m[5]]
    kept = good
    for name, (*ends, margin) in quality.RULES.items():
        quantiles = lambda rows: np.quantile([s[name] for _, s in rows], ends, method="inverted_cdf")  # noqa: B023, E731
        limits = {}
        for group in {r[2:4] for r, _ in good}:
            own = [(r, s) for r, s in good if r[2:4] == group]
            low, high = (len(own) * quantiles(own) + quality.PRIOR * quantiles(good)) / (len(own) + quality.PRIOR)
            slack = quality.REACH * (high - low) + margin
            limits[group] = low - slack if name == "word_length" else 0, high + slack
        kept = [(r, s) for r, s in kept if limits[r[2:4]][0] <= s[name] <= limits[r[2:4]][1]]
    return [r for r, _ in kept]


def lines_by_hand(rows):
    sites, first = defaultdict(set), {}
    for r in sorted(rows):
        for line in r[1].split("\n"):
            if line.strip(line_dedup.SPACE):
                sites[line].add(r[3])
                first.setdefault(line, r[0])
    out = []
    for r in rows:
        text = "\n".join(x for x in r[1].split("\n") if len(sites[x]) < line_dedup.MIN_SITES or first[x] == r[0])
        out.append((r[0], text, r[2], r[3], len(text), r[5]))
    return out


def test_every_stage(spark, tables, sf_dir):
    rows = tables[0]
    by_hand = [
        quality_by_hand,
        lines_by_hand,
        lambda rs: [r for r in rs if groups_by_hand(rs, 5).get(r[0], r[0]) == r[0]],
        lambda rs: [r for r in rs if not contamination_by_hand(r[1], tables[1])[3]],
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for (name, stage), hand in zip(corpus_pipeline.STAGES, by_hand, strict=False):
        before = len(rows)
        rows = hand(rows)
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), "test")
        assert docs.columns == DOCUMENTS.replace(" long", "").replace(" string", "").split(", ")
        assert Counter(map(tuple, docs.collect())) == Counter(rows), name
        assert len(rows) < before or name == "line_dedup"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == {r[0] for r in rows}
    assert check_packing(packed, SIZE) > 0.9
    whole = corpus_pipeline.run(spark, sf_dir)
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in whole.collect()) == Counter(
        (r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in packed
    )


def test_the_pipeline_of_nothing(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.lit(False))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
