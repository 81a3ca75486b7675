"""Running totals and row numbers over a global order without a single-task window.

Rows are dealt to tasks by ranges of the order, which Spark balances by count, so close values
and far ones are divided alike. The result is written, so that every later step sees the same
ranges. Totals then run inside each range and over the ranges, and the two are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.session import materialise


def _ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with the number of the range each row falls into; ranges follow the order."""
    return materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")


def _before(ranges: DataFrame, totals: dict[str, Column], within: Sequence[str]) -> DataFrame:
    """What all earlier ranges hold: one row per range and group, as many as there are tasks."""
    sums = ranges.groupBy(*within, "_range").agg(*[c.alias(f"_b_{t}") for t, c in totals.items()])
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *[F.col(c).alias(f"_of_{c}") for c in [*within, "_range"]],
        *[F.coalesce(F.sum(f"_b_{t}").over(earlier), F.lit(0)).alias(f"_b_{t}") for t in totals],
    )


def _joined(ranges: DataFrame, before: DataFrame, within: Sequence[str]) -> DataFrame:
    return ranges.join(before, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*within, "_range"]])


def running_totals(
    df: DataFrame,
    by: str,
    totals: Sequence[str],
    within: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``<total>_upto`` to a frame that has one row per (within, by), in order of ``by``."""
    order = F.desc(by) if descending else F.asc(by)
    ranges = _ranges(df, [order])
    inside = Window.partitionBy(*within, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranges.withColumns({f"_r_{t}": F.sum(t).over(inside) for t in totals})
    before = _before(ranges, {t: F.sum(t) for t in totals}, within)
    return _joined(local, before, within).select(
        *df.columns, *[(F.col(f"_r_{t}") + F.col(f"_b_{t}")).alias(f"{t}_upto") for t in totals]
    )


def numbered(df: DataFrame, order: Sequence[str], name: str, within: Sequence[str] = ()) -> DataFrame:
    """Add ``name``, the number of each row (from 1) in the given order, per group if ``within`` is given.

    The order decides between any two rows of a group, or they are alike.
    """
    ranges = _ranges(df, [F.asc(c) for c in order])
    inside = Window.partitionBy(*within, "_range").orderBy(*order)
    local = ranges.withColumn("_number", F.row_number().over(inside))
    return _joined(local, _before(ranges, {"n": F.count("*")}, within), within).select(
        *df.columns, (F.col("_number") + F.col("_b_n")).alias(name)
    )
