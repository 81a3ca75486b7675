"""Profiling of the delay dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe import constants as K
from skyframe.functions.columns import class_label
from skyframe.functions.ordering import running_totals
from skyframe.sources.flights import null_counts_row

QUARTILES = (0.25, 0.5, 0.75)


def features_only(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    return df.drop(target)


def target_only(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    return df.select(target)


def select_features(df: DataFrame, columns: Sequence[str] = tuple(K.FEATURE_COLUMNS)) -> DataFrame:
    """Exactly the model's columns in order: absent ones null, extra ones dropped."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(None).alias(c) for c in columns])


def class_balance(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(F.col(target).alias("class")).agg(F.count("*").alias("flights"))
    return (
        counts.withColumn("label", class_label("class"))
        .withColumn("share", F.col("flights") / counts.agg(F.sum("flights")).scalar())
        .orderBy("class")
    )


def _rates(df: DataFrame, key: str, name: str, target: str) -> DataFrame:
    """Flights, delay rate and overall rate per key.

    The overall rate is a subquery over the grouped counts, whose shuffle Spark reuses.
    """
    counts = df.groupBy(F.col(key).alias(name)).agg(
        F.count("*").alias("flights"), F.sum(F.col(target).cast("long")).alias("_delayed")
    )
    overall = counts.agg(F.sum("_delayed") / F.sum("flights")).scalar()
    return (
        counts.withColumn("delay_rate", F.col("_delayed") / F.col("flights"))
        .withColumn("overall_rate", overall)
        .drop("_delayed")
    )


def delay_rate_by_dow(df: DataFrame, day: str = "DayOfWeek", target: str = K.TARGET) -> DataFrame:
    return _rates(df, day, "day_of_week", target).orderBy("day_of_week")


def delay_rate_top_airlines(
    df: DataFrame, airline: str = "Airline", target: str = K.TARGET, top: int = K.TOP_CARRIERS
) -> DataFrame:
    """Delay rate of the busiest carriers, worst first; equal volumes are ordered by name."""
    busiest = _rates(df, airline, "airline", target).orderBy(F.desc("flights"), "airline").limit(top)
    return busiest.orderBy(F.desc("delay_rate"), "airline")


def distinct_counts(df: DataFrame, columns: dict[str, str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; every task drops its own repeats before the shuffle."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(name) for name, c in columns.items()])


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from one pass."""
    return null_counts_row(df).unpivot([], df.columns, "column", "nulls")


def shape_dtypes(df: DataFrame) -> DataFrame:
    """Row count with position, name and type of each column."""
    layout = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    described = F.explode(
        F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("dtype")) for i, n, t in layout])
    )
    return df.agg(F.count("*").alias("rows")).select("rows", described.alias("c")).select("rows", "c.*")


def exact_quantiles(df: DataFrame, columns: Sequence[str], at: Sequence[float] = QUARTILES) -> DataFrame:
    """Linearly interpolated quantiles, one row per column and a field ``q0, q1, ..`` per level.

    Values are counted inside each task, so a value shuffles once per task however often it
    occurs; running totals of the counts then tell which values hold the wanted ranks.
    """
    counts = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = running_totals(counts, "value", ["n"], ["column"])
    sizes = placed.groupBy("column").agg(F.sum("n").alias("size"))
    # Per level the two ranks to interpolate between, counted from 0.
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(at)]))
    h = (F.col("size") - 1) * F.col("l.q")
    ranks = sizes.select("column", levels.alias("l"), "size").select(
        "column",
        F.col("l.i").alias("i"),
        (h - F.floor(h)).alias("weight"),
        F.explode(F.array(F.struct(F.lit("lo").alias("end"), F.floor(h).alias("rank")), F.struct(F.lit("hi").alias("end"), F.ceil(h).alias("rank")))).alias("e"),
    ).select("column", "i", "weight", "e.*")
    # At most two ranks per level and column.
    found = placed.join(F.broadcast(ranks), "column").where(
        (F.col("n_upto") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("n_upto"))
    )
    ends = found.groupBy("column").agg(
        *[
            F.max(F.when((F.col("i") == i) & (F.col("end") == end), F.col("value"))).alias(f"{end}{i}")
            for i in range(len(at))
            for end in ("lo", "hi")
        ],
        *[F.max(F.when(F.col("i") == i, F.col("weight"))).alias(f"w{i}") for i in range(len(at))],
    )
    return ends.select(
        "column",
        *[
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}")).alias(f"q{i}")
            for i in range(len(at))
        ],
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of the numeric columns."""
    columns = list(columns or numeric_columns(df))
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            ).alias(f"_{c}")
        )
    moments = df.agg(F.array(*aggs).alias("m")).select(F.inline("m"))
    q = exact_quantiles(df, columns).withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"})
    return moments.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram_by_class(df: DataFrame, column: str, bins: int, target: str = K.TARGET) -> DataFrame:
    """Counts per class in equal-width bins over the column's whole range, empty bins too; the last bin is closed.

    The range comes from scalar subqueries, so the counting pass needs no join.
    """
    x = F.col(column)
    lo = df.select(F.min(x)).scalar()
    hi = df.select(F.max(x)).scalar()
    bounded = df.select(x.cast("double").alias("x"), F.col(target).alias("class"), lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))
    )
    counted = (
        bounded.groupBy("class", slot.cast("int").alias("bin"), "lo", width.alias("width"))
        .agg(F.count("x").alias("flights"))
    )
    # A zero for every bin of every class; as many rows as the result has.
    frame = counted.select("class", "lo", "width").distinct().select(
        "class", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "width", F.lit(0).cast("long").alias("flights")
    )
    return (
        counted.where(F.col("bin").isNotNull())
        .unionByName(frame)
        .groupBy("class", "bin", "lo", "width")
        .agg(F.sum("flights").alias("flights"))
        .select(
            "class",
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            "flights",
        )
    )


def split_summary(split: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Rows, share and delay rate per split, with the size (1 point) and rate (2 points) checks."""
    wanted = F.when(F.col("split") == "test", K.TEST_SHARE).when(F.col("split") == "val", K.VAL_SHARE)
    wanted = wanted.otherwise(1 - K.TEST_SHARE - K.VAL_SHARE)
    rates = _rates(split, "split", "split", target).withColumnRenamed("flights", "rows")
    return (
        rates.withColumn("share", F.col("rows") / rates.agg(F.sum("rows")).scalar())
        .withColumn("size_ok", F.abs(F.col("share") - wanted) < 0.01)
        .withColumn("rate_ok", F.abs(F.col("delay_rate") - F.col("overall_rate")) < 0.02)
    )
