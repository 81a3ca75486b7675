"""The registered queries of this folder, over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.llm import (
    decontaminate,
    hard_negatives,
    lattice_lm,
    line_dedup,
    near_dedup,
    nn_descent,
    packing,
    pii,
    pii_labelled,
    quality,
    repeats,
    token_counts,
    warc,
    whitening,
)
from skyframe.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PACK_FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@query()
def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


#: SHA-1 in base 32: each five hex digits are four letters.
PAGE_SQL = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
responses AS (SELECT hex, min(page_id) AS first_id FROM payloads GROUP BY hex)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT, 1)), '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN responses USING (hex)
"""


@query(PAGE_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train_from(pii_labelled.default_labelled(spark))
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), field)

    def of_kind(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[of_kind(k) for k in pii.KINDS],
        F.sha2(pii.written_spans(F.col("base")), 256).alias("base_sha256"),
        pii.written_spans(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_verdicts(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _words_sql(name: str, key: str, source: str) -> str:
    upper = "".join(map(chr, range(65, 91)))
    return f"""{name} AS (
    SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM {source}
)"""


WINDOW_SQL = f"""
WITH {_words_sql("items", "item_id", "benchmark")},
{_words_sql("docs", "doc_id", "documents")},
cut AS (SELECT item_id, words, least(len(words), {decontaminate.WINDOW}) AS n FROM items WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS part
    FROM cut, unnest(range(1, len(words) - n + 2)) AS u(i)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS part
    FROM docs, sizes, unnest(range(1, len(words) - n + 2)) AS u(i)
),
found AS (SELECT p.doc_id, p.n, p.i, w.item_id FROM places p JOIN windows w ON p.n = w.n AND p.part = w.part),
hits AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query(WINDOW_SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


LINE_SQL = f"""
WITH lines AS (
    SELECT doc_id, source, i, lines[i] AS line
    FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        unnest(range(1, len(lines) + 1)) AS u(i)
),
spread AS (
    SELECT line, min(doc_id) AS first_id FROM lines
    WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\x0C\\r]')
    GROUP BY line HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}
),
marked AS (
    SELECT l.*, s.line IS NOT NULL AND l.doc_id <> s.first_id AS gone
    FROM lines l LEFT JOIN spread s ON l.line = s.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query(LINE_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.remove_spread_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), PACK_FILES, 1024)


@query()
def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nn_descent.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), 0.9)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query()
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(hard_negatives.is_whole(F.col("embedding")))
    rows = vectors.select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda c: F.floor(c.cast("double") * 256)).alias("x"),
    )
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))
