"""Questions the live maps ask of the position table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.columns import aircraft_label, flight_phase, phase_arrow
from skyframe.schemas import CURRENT_COLUMNS


def positioned(positions: DataFrame) -> DataFrame:
    return positions.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def current_aircraft(positions: DataFrame) -> DataFrame:
    """Every positioned row, in the shape of the live-map service."""
    return positioned(positions).select(*CURRENT_COLUMNS)


def latest_per_aircraft(positions: DataFrame) -> DataFrame:
    """Newest row per (icao24, callsign).

    A null ``time_position`` counts as newest and the higher id breaks ties. Spark
    keeps one row per key in every map task before it shuffles (WindowGroupLimit), so a
    key that holds much of the table never meets in one task.
    """
    w = Window.partitionBy("icao24", "callsign").orderBy(
        F.desc_nulls_first("time_position"), F.desc("id")
    )
    return positions.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def live_kpis(latest: DataFrame) -> DataFrame:
    """Aircraft, those known to be in flight, newest position (as epoch seconds and text)."""
    newest = F.max("time_position")
    return latest.agg(
        F.count("*").alias("aircraft"),
        F.count_if(~F.col("on_ground")).alias("in_flight"),
        newest.alias("newest_position"),
        F.date_format(F.timestamp_seconds(newest), "yyyy-MM-dd HH:mm 'UTC'").alias("newest_position_text"),
    )


def status_line(current: DataFrame) -> DataFrame:
    newest = F.date_format(F.max("updated_at"), "yyyy-MM-dd HH:mm:ss 'UTC'")
    return current.agg(
        F.count("*").alias("aircraft"),
        F.concat(
            F.count("*").cast("string"),
            F.lit(" aircraft — last updated: "),
            F.coalesce(newest, F.lit("n/a")),
        ).alias("status"),
    )


def with_flight_phase(positions: DataFrame) -> DataFrame:
    return positions.withColumn("flight_phase", flight_phase("vertical_rate")).withColumn(
        "arrow", phase_arrow("vertical_rate")
    )


def marker_columns(current: DataFrame) -> DataFrame:
    """Marker text, heading and colour. An unknown ground flag counts as airborne."""
    grounded = F.coalesce(F.col("on_ground"), F.lit(False))
    ground_text = F.when(grounded, "On ground").otherwise("Airborne")
    label = aircraft_label("callsign", "icao24")
    return positioned(current).select(
        "icao24",
        "latitude",
        "longitude",
        label.alias("label"),
        ground_text.alias("ground_text"),
        flight_phase("vertical_rate").alias("trend"),
        phase_arrow("vertical_rate").alias("arrow"),
        F.coalesce(F.col("true_track"), F.lit(0.0)).alias("heading"),
        F.when(grounded, K.GROUND_COLOR).otherwise(K.AIRBORNE_COLOR).alias("color"),
        F.concat_ws(" — ", label, ground_text, flight_phase("vertical_rate")).alias("tooltip"),
    )


def position_display(latest: DataFrame) -> DataFrame:
    """Table view: display headers, UTC time, callsign order with missing ones last."""
    shown = latest.withColumn("time_position", F.timestamp_seconds("time_position"))
    return (
        shown.orderBy(F.asc_nulls_last("callsign"))
        .select(*K.DISPLAY_HEADERS)
        .withColumnsRenamed(K.DISPLAY_HEADERS)
    )


def duplicate_keys(positions: DataFrame) -> DataFrame:
    """(icao24, time_position) pairs stored more than once; a null in either never repeats."""
    return (
        positions.where(F.col("icao24").isNotNull() & F.col("time_position").isNotNull())
        .groupBy("icao24", "time_position")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def staleness(stamps: DataFrame, column: str, limit_seconds: int, by: tuple[str, ...] = (), now=None) -> DataFrame:
    """Seconds since the newest success, per feed or for the whole table, against its limit."""
    now = F.current_timestamp() if now is None else now
    newest = stamps.groupBy(*by).agg(F.max(column).alias("newest"))
    age = (F.unix_micros(now) - F.unix_micros(F.col("newest").cast("timestamp"))) / 1e6
    return newest.withColumn("age_seconds", age).withColumn(
        "healthy", F.coalesce(F.col("age_seconds") <= limit_seconds, F.lit(False))
    )
