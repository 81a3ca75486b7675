"""Exact evaluation metrics of a binary score.

Everything starts from one row per distinct score, with its positives and negatives,
merged inside each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.columns import class_label
from skyframe.functions.ordering import running_totals

THRESHOLD = 0.5


def score_counts(scored: DataFrame, score: str, target: str, within: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*within, F.col(score).alias("p")).agg(
        F.count_if(F.col(target) == 1).alias("pos"), F.count_if(F.col(target) != 1).alias("neg")
    )


def _ranked(scored: DataFrame, score: str, target: str, within: Sequence[str]) -> DataFrame:
    counts = score_counts(scored, score, target, within)
    return running_totals(counts, "p", ["pos", "neg"], within=within, descending=True)


def classification_metrics(
    scored: DataFrame,
    score: str = "probability_delayed",
    target: str = K.TARGET,
    within: Sequence[str] = (),
) -> DataFrame:
    """accuracy, precision, recall, f1, roc_auc and pr_auc, per group if ``within`` is given.

    ``pr_auc`` is the step sum of precision over recall (average precision). Tied
    scores count half in ``roc_auc`` and share one step in ``pr_auc``.
    """
    yes = F.col("p") >= THRESHOLD
    above = F.col("pos_upto") - F.col("pos")
    precision_here = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    sums = (
        _ranked(scored, score, target, within)
        .groupBy(*within)
        .agg(
            F.sum("pos").alias("P"),
            F.sum("neg").alias("N"),
            F.coalesce(F.sum(F.when(yes, F.col("pos"))), F.lit(0)).alias("tp"),
            F.coalesce(F.sum(F.when(yes, F.col("neg"))), F.lit(0)).alias("fp"),
            F.sum(F.col("neg").cast("double") * (above + F.col("pos") / 2)).alias("wins"),
            F.sum(F.col("pos") * precision_here).alias("steps"),
        )
    )
    tp, fp = F.col("tp"), F.col("fp")
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, F.col("P")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, F.col("P") + tp + fp), F.lit(0.0))
    return sums.select(
        *within,
        ((tp + F.col("N") - fp) / (F.col("P") + F.col("N"))).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        F.try_divide("wins", F.col("P").cast("double") * F.col("N")).alias("roc_auc"),
        F.try_divide("steps", F.col("P").cast("double")).alias("pr_auc"),
    )


def confusion_matrix(scored: DataFrame, predicted: str = "predicted_class", target: str = K.TARGET) -> DataFrame:
    """All four cells with labels, zero cells included, from one aggregate."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counted = scored.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("actual_class"),
                    F.lit(p).alias("predicted_class"),
                    F.count_if((F.col(target) == a) & (F.col(predicted) == p)).alias("flights"),
                )
                for a, p in cells
            ]
        ).alias("c")
    ).select(F.inline("c"))
    return counted.withColumn("actual_label", class_label("actual_class")).withColumn(
        "predicted_label", class_label("predicted_class")
    )


def roc_points(scored: DataFrame, score: str = "probability_delayed", target: str = K.TARGET) -> DataFrame:
    """False and true positive rate at every distinct threshold, plus the origin (threshold null)."""
    ranked = _ranked(scored, score, target, ())
    totals = score_counts(scored, score, target).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    positives, negatives = totals.select("P").scalar(), totals.select("N").scalar()
    points = ranked.select(
        F.col("p").alias("threshold"),
        F.try_divide("neg_upto", negatives).alias("fpr"),
        F.try_divide("pos_upto", positives).alias("tpr"),
    )
    origin = totals.select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)
