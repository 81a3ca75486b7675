"""Remove lines that appear on many distinct sites.

Built-in functions only. Lines travel as 64-bit hashes with their place, never as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import materialise

SPACE = " \t\n\x0b\x0c\r"

#: A line on this many distinct sites or more is boilerplate.
MIN_SITES = 10
#: Sketches of 2^12 registers; estimates this far from the threshold are taken as they are (over six standard errors).
LOG_REGISTERS = 12
NEAR = 0.1


def _lines(text_col: str) -> Column:
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")


def line_places(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per line with a word: document, hash of its text, site, place and hash of the line."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(site_col).alias("site"),
        F.posexplode(_lines(text_col)).alias("place", "line"),
    ).select(
        "id", "text_hash", "site", "place",
        F.when(F.btrim("line", F.lit(SPACE)) != "", F.xxhash64("line")).alias("line_hash"),
    )


def spread_lines(places: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line_hash, first_id`` of the lines on at least ``min_sites`` distinct sites.

    A sketch of sites per line is merged from task to task. Where its estimate is near the
    threshold, the distinct sites are counted exactly. A null site is no site.
    """
    seen = places.where("line_hash IS NOT NULL")
    estimates = materialise(
        seen.groupBy("line_hash")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg(F.col("site").cast("string"), F.lit(LOG_REGISTERS))).alias("sites"),
            F.min("id").alias("first_id"),
        )
        .where(F.col("sites") >= int(min_sites * (1 - NEAR))),
        "line-sites",
    )
    clear = F.col("sites") > min_sites * (1 + NEAR)
    near = estimates.where(~clear)
    exact = (
        seen.join(near.select("line_hash", "first_id"), "line_hash")
        .select("line_hash", "first_id", "site")
        .groupBy("line_hash", "first_id")
        .agg(F.count_distinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return estimates.where(clear).select("line_hash", "first_id").unionByName(exact.select("line_hash", "first_id"))


def remove_spread_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """``docs`` without boilerplate lines, with ``n_lines`` and ``n_removed`` per row.

    A line is boilerplate if it holds a word and stands, letter for letter, on at least
    ``min_sites`` distinct sites. The document with the smallest id keeps it, so no text is lost
    altogether. Other lines and their order stay. A null text stays null; rows that repeat an id
    are told apart by their text; a null id comes after all others. Columns named ``n_lines`` or
    ``n_removed`` are replaced, and an empty table gives no rows.
    """
    carried = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    places = materialise(line_places(docs, id_col, text_col, site_col), "line-places")
    spread = spread_lines(places, min_sites)
    gone = F.col("spread") & ~F.col("id").eqNullSafe(F.col("first_id"))
    flagged = places.join(spread.withColumn("spread", F.lit(True)), "line_hash", "left").select(
        "id", "text_hash", "place", F.coalesce(gone, F.lit(False)).alias("gone")
    )
    marks = (
        flagged.groupBy("id", "text_hash")
        .agg(F.max("gone").alias("any"), F.sort_array(F.collect_set(F.struct("place", "gone"))).alias("marks"))
        .where("any")
        .select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_text_hash"), "marks")
    )
    # Carried columns travel in one struct, so that no name of theirs can clash.
    rows = docs.select(
        F.struct(*[c for c in carried if c != text_col]).alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
    )
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text_hash")), "left")
    left = F.filter(
        F.zip_with(_lines("text"), F.col("marks"), lambda line, m: F.when(~m["gone"], line)), lambda x: x.isNotNull()
    )
    text = F.when(F.col("marks").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in carried],
        F.size(_lines("text")).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter("marks", lambda m: m["gone"])), F.lit(0)).cast("long").alias("n_removed"),
    )
