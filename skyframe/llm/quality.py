"""Quality rules whose thresholds follow the documents of a language and source.

Built-in functions only. Word counts are taken inside the row, so a text is never spread
over rows or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import materialise

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Measures that thresholds are learnt for: a lower and an upper quantile, and the least distance
#: beyond them that counts. Most documents of a clean source repeat nothing, so the spread of
#: repeats is taken in their tail; for symbols it is taken where one dirty document in ten
#: does not move it.
RULES = {
    "word_length": (0.25, 0.75, 1.0),
    "symbol_share": (0.5, 0.8, 0.02),
    "repeat_line_share": (0.9, 0.99, 0.1),
    "repeat_word_share": (0.9, 0.99, 0.1),
}
#: How many times the distance of the quantiles a value must lie beyond them.
REACH = 3.0
#: The quantiles of all documents weigh as much as so many documents of the group.
PRIOR = 100
SKETCH_K = 800


def _neighbours(values: Column) -> Column:
    """Each element with the next and the previous one; one more, empty, at the end."""
    start = F.array(F.lit(None))
    return F.arrays_zip(
        values.alias("own"),
        F.slice(values, 2, F.greatest(F.size(values), F.lit(1))).alias("next"),
        F.concat(start, values).alias("last"),
    )


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_lines, n_symbols, n_dup_lines, n_repeat_words`` to every row.

    Words are runs of characters other than blank and ``\\t`` to ``\\r``. A null text has none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumn("_words", F.split(F.btrim(text, F.lit(SPACE)), "[ \\t-\\r]+"))
    # Trimmed text that is empty splits into one empty string.
    d = d.withColumn("_words", F.when(F.element_at("_words", 1) != "", F.col("_words")).otherwise(F.array().cast("array<string>")))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    three = F.arrays_zip(
        F.col("_words").alias("a"),
        F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))).alias("b"),
        F.slice("_words", 3, F.greatest(F.size("_words"), F.lit(1))).alias("c"),
    )
    d = d.withColumn("_keys", F.slice(F.transform(three, lambda w: F.xxhash64(w["a"], w["b"], w["c"])), 1, F.greatest(F.size("_words") - 2, F.lit(0))))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    d = d.withColumn("_lines", lines)
    d = d.withColumns(
        {
            "word_chars": F.char_length(F.translate(text, SPACE, "")).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            # Windows in order of their keys, only where one occurs twice.
            "_sorted": F.when(
                F.size(F.array_distinct("_keys")) < F.size("_keys"),
                F.array_sort(F.transform("_keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))),
            ),
        }
    )
    again = F.filter(
        _neighbours(F.col("_sorted")),
        lambda x: (x["own"]["k"] == x["next"]["k"]) | (x["own"]["k"] == x["last"]["k"]),
    )
    d = d.withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["own"]["i"])))
    # A window reaches three words on, or to where the next repeated one begins.
    reach = F.zip_with(
        "_starts", F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))
    )
    covered = F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return d.drop("_words", "_keys", "_lines", "_sorted", "_starts")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def shares() -> dict[str, Column]:
    return {
        "word_length": F.col("word_chars") / F.col("n_words"),
        "symbol_share": F.col("n_symbols") / F.col("word_chars"),
        "repeat_line_share": F.col("n_dup_lines") / F.col("n_lines"),
        "repeat_word_share": F.col("n_repeat_words") / F.col("n_words"),
    }


def fences(measured: DataFrame, by: Sequence[str]) -> DataFrame:
    """Lowest and highest value allowed per group: ``by, {measure}_least, {measure}_most``.

    One mergeable quantile sketch per group and measure; the sketches of the groups are merged for
    the quantiles of all documents (a few numbers). A group's quantiles are a mean of its own, by
    its number of documents, and of all, by ``PRIOR``, so that limits move smoothly with the size
    of a group. Documents that fail the fixed base rules do not shape the thresholds; a group of
    nothing else has no row.
    """

    def quantiles(name: str) -> list[Column]:
        return [F.kll_sketch_get_quantile_double(F.col(f"_{name}"), F.lit(p)).alias(f"{name}_{i}") for i, p in enumerate(RULES[name][:2])]

    sketches = materialise(
        measured.where(~base_failed())
        .select(*by, *[c.alias(n) for n, c in shares().items()])
        .groupBy(*by)
        .agg(F.count("*").alias("_n"), *[F.kll_sketch_agg_double(n, F.lit(SKETCH_K)).alias(f"_{n}") for n in RULES]),
        "sketches",
    )
    whole = sketches.agg(F.sum("_n").alias("_n"), *[F.kll_merge_agg_double(f"_{n}").alias(f"_{n}") for n in RULES])
    row = whole.where(F.col("_n") > 0).select(*[q for n in RULES for q in quantiles(n)]).first()
    overall = row.asDict() if row else {}
    ends = []
    for name, (_, _, margin) in RULES.items():
        low, high = [
            (F.col("_n") * F.col(f"{name}_{i}") + PRIOR * F.lit(overall.get(f"{name}_{i}"))) / (F.col("_n") + PRIOR) for i in (0, 1)
        ]
        slack = REACH * (high - low) + margin
        # A document can't have too few symbols or repeats.
        ends += [(low - slack if name == "word_length" else F.lit(0.0)).alias(f"{name}_least"), (high + slack).alias(f"{name}_most")]
    return sketches.select(*by, "_n", *[q for n in RULES for q in quantiles(n)]).select(*by, *ends)


ADDED = ["n_words", "word_chars", "n_lines", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def quality_verdicts(
    docs: DataFrame, text_col: str = "text", by: Sequence[str] = ("lang", "source"), carry: Sequence[str] | None = None
) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all by default) with measures, ``base_failed`` and ``kept``.

    A row is kept if it passes the base rules and none of its shares lies far outside the
    quantiles of its group, as ``fences`` has them. Null group values form a
    group of their own. A null or empty text fails the base rules, and so do all rows of a table
    with nothing but such texts. Repeated rows are judged alike. Columns of ``docs`` with the
    names of added ones are replaced; other names do not matter.
    """
    carried = [c for c in carry or docs.columns if c not in ADDED]
    keys = [f"by_{i}" for i in range(len(by))]
    # Carried columns travel in one struct, so that no name of theirs can clash.
    rows = docs.select(F.struct(*carried).alias("row"), F.col(text_col).alias("text"), *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)])
    measured = materialise(with_measures(rows).drop("text"), "measures")
    groups = fences(measured, keys)
    limits = groups.select(*[F.col(k).alias(f"of_{k}") for k in keys], *groups.columns[len(by) :])
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    judged = measured.join(limits, same, "left")
    passes = F.lit(True)
    for name, share in shares().items():
        passes = passes & (share >= F.col(f"{name}_least")) & (share <= F.col(f"{name}_most"))
    failed = base_failed()
    return judged.withColumns(
        {"base_failed": failed, "kept": F.when(failed, F.lit(False)).otherwise(F.coalesce(passes, F.lit(True)))}
    ).select(*[F.col(f"row.`{c}`").alias(c) for c in carried], *ADDED)
