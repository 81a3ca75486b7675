"""Where queries and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.plans.standins import with_views
from skyframe.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Instants as plain UTC timestamps, which any SQL engine shows alike."""
    instants = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants}) if instants else df


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name or ``name``, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(use_utc(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return run

    return register
