"""Airline attribution and the designed star schema.

Lookups are left joins without a broadcast hint: Spark broadcasts a dimension only
when its measured size is under the session's threshold, and otherwise joins by
shuffle and splits skewed keys. Counts are taken per key before a dimension is
joined, so a busy aircraft or airline travels as one row per task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.functions.columns import callsign_prefix, clean_callsign, clean_code, distance_nm
from skyframe.operators.unify import keyed_aircraft, unify_positions
from skyframe.schemas import LEGS_DOCUMENT, POSITION_COLUMNS

NM_PER_DEGREE = 60.0


def resolve_airline(facts: DataFrame, dim_aircraft: DataFrame, dim_airlines: DataFrame) -> DataFrame:
    """Add ``airline_icao``: the registered operator, else the callsign's prefix.

    Addresses match in any case (the register has them in lower case), prefixes likewise.
    Each candidate must be a known airline, so an unknown operator falls through to
    the prefix. Every fact row survives. The operator is checked against the airlines
    inside the dimensions, which leaves two lookups per fact row.
    """
    known = dim_airlines.select(F.col("icao_code").alias("airline_icao"))
    operators = dim_aircraft.join(
        known, dim_aircraft["operator_icao"] == known["airline_icao"], "left_semi"
    ).select(F.col("icao24").alias("_address"), F.col("operator_icao").alias("_operator"))
    prefixes = dim_airlines.select(F.col("icao_code").alias("_prefix"))
    return (
        facts.withColumn("_prefix_candidate", F.upper(callsign_prefix("callsign")))
        .join(operators, F.lower(facts["icao24"]) == F.col("_address"), "left")
        .drop("_address")
        .join(prefixes, F.col("_prefix_candidate") == F.col("_prefix"), "left")
        .withColumn("airline_icao", F.coalesce("_operator", "_prefix"))
        .drop("_operator", "_prefix", "_prefix_candidate")
    )


def flights_per_airline_star(resolved: DataFrame, dim_airlines: DataFrame) -> DataFrame:
    """Observations per airline name through the resolved code (one hop)."""
    per_code = resolved.groupBy("airline_icao").agg(F.count("*").alias("n"))
    return (
        per_code.join(dim_airlines, F.col("airline_icao") == F.col("icao_code"))
        .groupBy("name")
        .agg(F.sum("n").alias("flights"))
    )


def flights_per_airline_snowflake(
    facts: DataFrame, dim_aircraft: DataFrame, dim_airlines: DataFrame
) -> DataFrame:
    """Observations per airline name through the airframe's operator (two hops)."""
    per_aircraft = facts.groupBy("icao24").agg(F.count("*").alias("n"))
    return (
        per_aircraft.join(dim_aircraft.select("icao24", "operator_icao"), "icao24")
        .groupBy("operator_icao")
        .agg(F.sum("n").alias("n"))
        .join(dim_airlines, F.col("operator_icao") == F.col("icao_code"))
        .groupBy("name")
        .agg(F.sum("n").alias("flights"))
    )


def match_feeds(positional: DataFrame, keyed: DataFrame) -> DataFrame:
    """Newest row per aircraft in each feed, side by side, with their differences.

    Each side is reduced to one row per aircraft before the full join, so the join
    key is unique on both sides.
    """

    def newest(rows: DataFrame, tag: str) -> DataFrame:
        w = Window.partitionBy("aircraft").orderBy(F.desc_nulls_last("time_position"), F.desc("id"))
        return (
            rows.withColumn("aircraft", F.lower("icao24"))
            .where(F.col("aircraft").isNotNull())
            .withColumn("_rank", F.row_number().over(w))
            .where("_rank = 1")
            .select(
                "aircraft",
                F.lit(True).alias(f"in_{tag}"),
                *[
                    F.col(c).alias(f"{c}_{tag}")
                    for c in ("callsign", "time_position", "longitude", "latitude", "on_ground")
                ],
            )
        )

    both = newest(positional, "positional").join(newest(keyed, "keyed"), "aircraft", "full")
    seen_p, seen_k = F.col("in_positional").isNotNull(), F.col("in_keyed").isNotNull()
    return both.select(
        "aircraft",
        F.when(seen_p & seen_k, "both").when(seen_p, "positional").otherwise("keyed").alias("seen_in"),
        (F.col("time_position_keyed") - F.col("time_position_positional")).alias("time_diff"),
        (F.col("longitude_keyed") - F.col("longitude_positional")).alias("longitude_diff"),
        (F.col("latitude_keyed") - F.col("latitude_positional")).alias("latitude_diff"),
        clean_callsign("callsign_keyed")
        .eqNullSafe(clean_callsign("callsign_positional"))
        .alias("same_callsign"),
        F.col("on_ground_keyed").eqNullSafe(F.col("on_ground_positional")).alias("same_ground"),
    )


def iata_icao_map(airports: DataFrame) -> DataFrame:
    """Airport code mapping: one ICAO code per IATA code, the smallest where several share it."""
    iata, icao = clean_code("iata_code"), clean_code("icao_code")
    return (
        airports.select(F.nullif(iata, F.lit("")).alias("iata_code"), F.nullif(icao, F.lit("")).alias("icao_code"))
        .where("iata_code IS NOT NULL AND icao_code IS NOT NULL")
        .groupBy("iata_code")
        .agg(F.min("icao_code").alias("icao_code"))
    )


def with_icao(rows: DataFrame, iata_column: str, mapping: DataFrame) -> DataFrame:
    """Add the ICAO code of an IATA column; rows without a mapping keep a null."""
    m = mapping.select(F.col("iata_code").alias("_iata"), F.col("icao_code").alias(f"{iata_column}_icao"))
    return rows.join(m, F.col(iata_column) == F.col("_iata"), "left").drop("_iata")


def newest_observation(rows: DataFrame) -> DataFrame:
    """One row per (icao24, observed_at): the same aircraft can sit in several documents of one call.

    The row with the newest position is kept, chosen map-side first.
    """
    w = Window.partitionBy("icao24", "observed_at").orderBy(
        F.desc_nulls_last("time_position"),
        *[F.asc_nulls_last(c) for c in POSITION_COLUMNS if c not in ("icao24", "time_position")],
    )
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def observations(docs: DataFrame) -> DataFrame:
    """Every observation of the documents, newest per (icao24, observed_at) among them."""
    rows = unify_positions(docs).withColumnRenamed("updated_at", "observed_at").drop("created_at")
    return newest_observation(rows.where(F.col("icao24").isNotNull()))


def build_fact_states(docs: DataFrame, dim_aircraft: DataFrame, dim_airlines: DataFrame) -> DataFrame:
    """Every observation of every landed snapshot, key (icao24, observed_at), airline resolved."""
    return resolve_airline(observations(docs), dim_aircraft, dim_airlines)


def stub_aircraft(facts: DataFrame, dim_aircraft: DataFrame) -> DataFrame:
    """The aircraft dimension plus an attribute-less row for each unseen address, in lower case."""
    unseen = (
        facts.select(F.lower("icao24").alias("icao24"))
        .where(F.col("icao24").isNotNull())
        .distinct()
        .join(dim_aircraft.select("icao24"), "icao24", "left_anti")
    )
    return dim_aircraft.withColumn("is_stub", F.lit(False)).unionByName(
        unseen.withColumn("is_stub", F.lit(True)), allowMissingColumns=True
    )


def adsb_positions(docs: DataFrame) -> DataFrame:
    """Wide flatten of the keyed feed: numeric altitude, "ground" as null, key (hex, collected_at).

    A row needs the key, a position and a time of last contact.
    """
    a = F.col("a")

    def num(field: str, dtype: str):
        return a[field].try_cast("double").try_cast(dtype)

    rows = keyed_aircraft(docs).select(
        F.lower(a["hex"]).alias("hex"),
        clean_callsign(a["flight"]).alias("callsign"),
        a["r"].alias("registration"),
        a["t"].alias("aircraft_type"),
        num("lat", "double").alias("latitude"),
        num("lon", "double").alias("longitude"),
        num("alt_baro", "int").alias("altitude_baro"),
        num("alt_geom", "int").alias("altitude_geom"),
        num("gs", "double").alias("ground_speed"),
        num("track", "double").alias("track"),
        num("baro_rate", "int").alias("vertical_rate"),
        a["squawk"].alias("squawk"),
        F.timestamp_millis((F.col("now") - F.coalesce(num("seen_pos", "double"), F.lit(0.0)) * 1000).cast("long")).alias(
            "seen_at"
        ),
        F.col("fetched_at").alias("collected_at"),
    )
    return rows.where(
        "hex IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL "
        "AND seen_at IS NOT NULL AND collected_at IS NOT NULL"
    )


def dedup_overlaps(rows: DataFrame) -> DataFrame:
    """One row per (hex, collected_at) where overlapping queries returned an aircraft twice.

    The most recently seen position wins; Spark reduces each task before the shuffle.
    """
    w = Window.partitionBy("hex", "collected_at").orderBy(
        F.desc("seen_at"),
        *[F.asc_nulls_last(c) for c in rows.columns if c not in ("hex", "collected_at", "seen_at")],
    )
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def within_radius(
    rows: DataFrame, lat0: float, lon0: float, radius_nm: float, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Rows within a radius of a point, with ``distance_nm``.

    Bands of latitude and longitude, which a scan can skip files by, run before the trigonometry.
    The hair of slack keeps rounding from cutting rows on the rim.
    """
    reach = radius_nm / NM_PER_DEGREE * 1.001
    band = F.col(lat).between(max(lat0 - reach, -90.0), min(lat0 + reach, 90.0))
    edge = math.cos(math.radians(min(abs(lat0) + reach, 90.0)))
    # A box that crosses the date line or comes near a pole has no simple band of longitudes.
    across = reach / edge if edge > 0.01 else 360.0
    if -180.0 < lon0 - across and lon0 + across < 180.0:
        band &= F.col(lon).between(lon0 - across, lon0 + across)
    return (
        rows.where(band)
        .withColumn("distance_nm", distance_nm(lat, lon, lat0, lon0))
        .where(F.col("distance_nm") <= radius_nm)
    )


def lookup(
    rows: DataFrame,
    icao24: str | None = None,
    callsign: str | None = None,
    registration: str | None = None,
    squawk: str | None = None,
) -> DataFrame:
    """Find aircraft by address (asked in any case), callsign (whole, or a prefix ending in ``*``),
    registration or squawk; criteria given together must all hold.

    ``rows`` are stored as ``adsb_positions`` writes them, addresses in lower case and callsigns
    clean, so every criterion compares a column with a literal and reaches the files.
    """
    if icao24 is not None:
        rows = rows.where(F.col("icao24") == icao24.lower())
    if callsign is not None:
        text = F.col("callsign")
        rows = rows.where(
            F.startswith(text, F.lit(callsign[:-1])) if callsign.endswith("*") else text == callsign
        )
    if registration is not None:
        rows = rows.where(F.col("registration") == registration)
    if squawk is not None:
        rows = rows.where(F.col("squawk") == squawk)
    return rows


def flight_legs(docs: DataFrame) -> DataFrame:
    """Stored flight-leg documents as one row per leg, with the query that returned it."""
    parsed = docs.select(F.from_json("payload", LEGS_DOCUMENT).alias("d"), "fetched_at")
    legs = parsed.select(
        F.col("d.endpoint").alias("endpoint"),
        F.col("d.query_params.airport").alias("query_airport"),
        F.col("d.query_params.begin").alias("query_begin"),
        F.col("d.query_params.end").alias("query_end"),
        F.col("fetched_at").alias("collected_at"),
        F.explode("d.flights").alias("f"),
    )
    f = F.col("f")
    return legs.select(
        "endpoint",
        "query_airport",
        "query_begin",
        "query_end",
        "collected_at",
        f["icao24"].alias("icao24"),
        clean_callsign(f["callsign"]).alias("callsign"),
        f["firstSeen"].alias("first_seen"),
        f["lastSeen"].alias("last_seen"),
        f["estDepartureAirport"].alias("departure_airport"),
        f["estArrivalAirport"].alias("arrival_airport"),
        f["estDepartureAirportHorizDistance"].alias("departure_distance_m"),
        f["estArrivalAirportHorizDistance"].alias("arrival_distance_m"),
    )


def create_star_views(
    facts: DataFrame, dim_aircraft: DataFrame, dim_airlines: DataFrame, dim_airports: DataFrame
) -> list[str]:
    """Register the read views ``states``, ``aircraft``, ``airlines`` and ``airports``."""
    views = {"states": facts, "aircraft": dim_aircraft, "airlines": dim_airlines, "airports": dim_airports}
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)
