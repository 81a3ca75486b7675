"""A stored profile of a table: mergeable sketches per day, so that old rows are not read again.

A day is one row per column: counts, moments, ends, a KLL sketch of the values and a HyperLogLog
sketch of the distinct ones. Profiles of any days merge these rows. ``operators.profile`` has the
exact forms, which read all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of a quantile sketch. A rank is off by at most ``RANK_ERROR`` of the rows in 99 of 100 sketches.
SKETCH_K = 1600
RANK_ERROR = 2.296 / SKETCH_K**0.9021
#: 2^12 registers: three standard errors of a distinct count.
DISTINCT_BITS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _one_column(df: DataFrame, name: str) -> Column:
    """What is kept of a column; NaN is a missing value, and only numbers have quantiles."""
    value, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    number = value.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
    return F.struct(
        F.lit(name).alias("column"),
        F.count("*").alias("rows"),
        F.count(value).alias("count"),
        F.avg(number).alias("mean"),
        F.coalesce(F.var_pop(number) * F.count(number), F.lit(0.0)).alias("spread"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        F.kll_sketch_agg_double(number, F.lit(SKETCH_K)).alias("values"),
        F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), F.lit(DISTINCT_BITS)).alias("distinct"),
    )


def add_days(df: DataFrame, path: str, day: str, columns: Sequence[str] | None = None) -> None:
    """Profile the days of ``df`` and store them below ``path``; a day that is there already is replaced.

    Give whole days. Tasks sketch their own rows, so a day with most of the rows is no hot group.
    Rows without a day are a day of their own.
    """
    columns = [c for c in columns or df.columns if c != day]
    daily = df.groupBy(F.col(day).cast("string").alias("day")).agg(F.array(*[_one_column(df, c) for c in columns]).alias("columns"))
    rows = daily.select("day", F.inline("columns"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """The stored rows, of all days or of the named ones, whose folders alone are read."""
    stored = (
        "column string, rows long, count long, mean double, spread double, min double, max double, "
        "values binary, distinct binary, day string"
    )
    rows = spark.read.schema(stored).parquet(path)
    return rows if days is None else rows.where(F.col("day").isin(*days))


def merged(days: DataFrame) -> DataFrame:
    """One row per column over stored days, with its ``values`` sketch.

    ``count, nulls, mean, std, min, max`` are exact but for rounding. Quartiles are values whose rank
    is within ``RANK_ERROR`` of theirs, ``distinct`` is within ``DISTINCT_ERROR`` of the true count.
    A column without numbers has null for what only numbers have.
    """
    of_column = Window.partitionBy("column")
    numbers = F.when(F.col("mean").isNotNull(), F.col("count"))
    centre = F.sum(numbers * F.col("mean")).over(of_column) / F.sum(numbers).over(of_column)
    around = days.withColumn("centre", centre).withColumn(
        "spread", F.col("spread") + F.coalesce(numbers * F.pow(F.col("mean") - F.col("centre"), F.lit(2)), F.lit(0.0))
    )
    whole = around.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("count").alias("count"),
        F.first("centre").alias("mean"),
        F.sum("spread").alias("spread"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("values", F.lit(SKETCH_K)).alias("values"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
    )
    has = F.col("min").isNotNull()
    quartiles = [F.when(has, F.kll_sketch_get_quantile_double("values", F.lit(p))).alias(n) for n, p in QUARTILES.items()]
    std = F.when(has & (F.col("count") > 1), F.sqrt(F.col("spread") / (F.col("count") - 1)))
    return whole.select(
        "column", "count", (F.col("rows") - F.col("count")).alias("nulls"), "mean", std.alias("std"), "min", *quartiles, "max", "distinct", "values"
    )


def histogram(days: DataFrame, column: str, bins: int) -> DataFrame:
    """``bin, low, high, share`` in equal-width bins over a column's whole range, from its sketch.

    A share is off by at most twice ``RANK_ERROR``. Bins are closed below, the last one also above.
    """
    whole = merged(days.where(F.col("column") == column)).where("min IS NOT NULL").select("min", "max", "values")
    ends = whole.select("min", "max").first()
    low, high = (ends["min"], ends["max"]) if ends else (0.0, 0.0)
    edges = [low + (high - low) / bins * i for i in range(bins)] + [high]

    # The rank of a sketch counts what is at most the value, so an edge is asked for a hair below it.
    def below(i: int) -> Column:
        if i in (0, bins):
            return F.lit(float(i > 0))
        return F.kll_sketch_get_rank_double("values", F.lit(math.nextafter(edges[i], -math.inf)))

    one_bin = [
        F.struct(F.lit(i).alias("bin"), F.lit(edges[i]).alias("low"), F.lit(edges[i + 1]).alias("high"), (below(i + 1) - below(i)).alias("share"))
        for i in range(bins)
    ]
    return whole.select(F.inline(F.array(*one_bin)))
