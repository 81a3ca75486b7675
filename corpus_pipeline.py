"""Five stages that turn raw documents into packed training sequences.

Each stage reads what its predecessor kept, from a written table. All stages take nulls in any
column, repeated rows, columns of any name and an empty table, which stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.llm import decontaminate, line_dedup, near_dedup, packing, quality
from skyframe.llm.common import table
from skyframe.session import materialise

PACK_FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the thresholds of their language and source.

    A null or empty text fails; null languages and sources form groups of their own.
    """
    return quality.quality_verdicts(docs).where("kept").select(*docs.columns)


def line_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without lines that stand on many sites; ``n_chars`` follows the text.

    A null text stays null, and a row whose lines all go stays with an empty text.
    """
    cleaned = line_dedup.remove_spread_lines(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by 0.8 of their five-word shingles: that with the smallest id.

    Texts without words are linked with nothing; of rows with equal id and text one stays.
    """
    return near_dedup.drop_near_duplicates(docs, shingle=5, share=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which less than one word in twenty lies in a benchmark passage; those without words stay."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of 1,024 ids; a null text is empty and has its end id."""
    return packing.pack_documents(docs, PACK_FILES, 1024)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_removal),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack_sequences),
]

#: No SQL: quantile sketches, MinHash and byte-level BPE have no counterpart there.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
