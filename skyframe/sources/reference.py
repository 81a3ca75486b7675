"""Reference CSV files behind the dimensions. Files are read raw first, then projected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.functions.columns import clean_code, stripped

# Column order of the airline file, which has no header; ``\N`` marks a missing value.
AIRLINE_FILE_COLUMNS = ["airline_id", "name", "alias", "iata", "icao", "callsign", "country", "active"]
AIRLINE_FILE_NULL = "\\N"


def _raw(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.read.options(header="true", inferSchema="false", quote='"', escape='"', **options).csv(path)


def _text(name: str) -> Column:
    return F.nullif(stripped(name), F.lit(""))


def _code(name: str) -> Column:
    return F.nullif(clean_code(name), F.lit(""))


def dim_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airports that have an ICAO code, with their IATA code, name and position."""
    raw = _raw(spark, path)
    return raw.select(
        _code("icao_code").alias("icao_code"),
        _code("iata_code").alias("iata_code"),
        _text("name").alias("name"),
        F.col("latitude_deg").try_cast("double").alias("latitude"),
        F.col("longitude_deg").try_cast("double").alias("longitude"),
    ).where(F.col("icao_code").isNotNull())


def dim_aircraft(spark: SparkSession, path: str) -> DataFrame:
    """Aircraft register by lower-case address; the first row in code order of a repeated one."""
    raw = _raw(spark, path)
    row = F.struct(
        _text("registration").alias("registration"),
        _code("operatoricao").alias("operator_icao"),
        _text("manufacturername").alias("manufacturer"),
        _text("model").alias("model"),
    )
    return (
        raw.select(F.lower(_text("icao24")).alias("icao24"), row.alias("r"))
        .where(F.col("icao24").isNotNull())
        .groupBy("icao24")
        .agg(F.min("r").alias("r"))
        .select("icao24", "r.*")
    )


def dim_airlines(spark: SparkSession, path: str) -> DataFrame:
    """Airlines that have an ICAO code, one row per code."""
    raw = (
        spark.read.schema(", ".join(f"{c} string" for c in AIRLINE_FILE_COLUMNS))
        .options(header="false", quote='"', escape="\\", nullValue=AIRLINE_FILE_NULL)
        .csv(path)
    )
    row = F.struct(_text("name").alias("name"), _code("iata").alias("iata_code"), _text("country").alias("country"))
    return (
        raw.select(_code("icao").alias("icao_code"), row.alias("r"))
        .where(F.length("icao_code") == 3)
        .groupBy("icao_code")
        .agg(F.min("r").alias("r"))
        .select("icao_code", "r.*")
    )
