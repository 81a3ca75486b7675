"""Star schema, wide positions, look-ups and flight legs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.operators import cells, star
from skyframe.plans.position_queries import (
    HAS_POSITION,
    KEYED,
    KEYED_ROW,
    POSITIONAL,
    POSITIONAL_ROW,
    documents,
    landed,
)
from skyframe.plans.registry import query
from skyframe.plans.standins import PAGE_ROWS, view
from skyframe.session import materialise, new_folder
from skyframe.sources import reference, snapshots
from skyframe.streaming.facts import read_fact_states, stream_fact_states


def dims(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return view(spark, sf_dir, "dim_aircraft"), view(spark, sf_dir, "dim_airlines")


def resolved(rows: str) -> str:
    """SQL that adds ``airline_icao`` to a relation with ``icao24`` and ``callsign``."""
    return f"""
      SELECT f.*, coalesce(a1.icao_code, a2.icao_code) AS airline_icao FROM {rows} f
      LEFT JOIN dim_aircraft ac ON ac.icao24 = f.icao24
      LEFT JOIN dim_airlines a1 ON a1.icao_code = ac.operator_icao
      LEFT JOIN dim_airlines a2 ON a2.icao_code = nullif(substr(trim(f.callsign), 1, 3), '')
    """


@query(resolved("(SELECT id, icao24, callsign FROM positions)"))
def resolve_airline(spark, sf_dir):
    facts = view(spark, sf_dir, "positions").select("id", "icao24", "callsign")
    return star.resolve_airline(facts, *dims(spark, sf_dir))


MIXED_CASE = "(SELECT id, concat('A', icao24) AS icao24, lower(callsign) AS callsign FROM positions)"


@query(
    resolved(MIXED_CASE)
    .replace("ac.icao24 = f.icao24", "concat('a', ac.icao24) = lower(f.icao24)")
    .replace("nullif(substr(trim(f.callsign)", "nullif(substr(trim(upper(f.callsign))")
)
def resolve_airline_any_case(spark, sf_dir):
    """Addresses sent in upper case find the register's lower-case ones, and callsigns in lower case their airline."""
    facts = view(spark, sf_dir, "positions").select("id", F.concat(F.lit("A"), "icao24").alias("icao24"), F.lower("callsign").alias("callsign"))
    aircraft, airlines = dims(spark, sf_dir)
    return star.resolve_airline(facts, aircraft.withColumn("icao24", F.concat(F.lit("a"), "icao24")), airlines)


@query(
    f"""
    SELECT name, count(*) AS flights FROM ({resolved("(SELECT icao24, callsign FROM positions)")}) r
    JOIN dim_airlines d ON d.icao_code = r.airline_icao GROUP BY name
    """
)
def flights_per_airline_star(spark, sf_dir):
    aircraft, airlines = dims(spark, sf_dir)
    facts = star.resolve_airline(view(spark, sf_dir, "positions"), aircraft, airlines)
    return star.flights_per_airline_star(facts, airlines)


@query(
    """
    SELECT name, count(*) AS flights FROM positions f JOIN dim_aircraft ac ON ac.icao24 = f.icao24
    JOIN dim_airlines al ON al.icao_code = ac.operator_icao GROUP BY name
    """
)
def flights_per_airline_snowflake(spark, sf_dir):
    return star.flights_per_airline_snowflake(view(spark, sf_dir, "positions"), *dims(spark, sf_dir))


NEWEST_PER_FEED = """
    n AS (SELECT lower(icao24) AS aircraft, * FROM obs o
      WHERE fetched_at = (SELECT max(fetched_at) FROM obs x WHERE x.source = o.source)),
    r AS (SELECT *, nullif(trim(callsign_raw), '') AS cs, row_number() OVER (
      PARTITION BY source, aircraft ORDER BY time_position DESC NULLS LAST, id DESC) AS rn FROM n),
"""


@query(
    f"""
    WITH {NEWEST_PER_FEED}
    p AS (SELECT * FROM r WHERE rn = 1 AND {POSITIONAL}), k AS (SELECT * FROM r WHERE rn = 1 AND {KEYED})
    SELECT coalesce(p.aircraft, k.aircraft) AS aircraft,
      CASE WHEN p.aircraft IS NULL THEN 'keyed' WHEN k.aircraft IS NULL THEN 'positional' ELSE 'both' END AS seen_in,
      k.time_position - p.time_position AS time_diff, k.longitude - p.longitude AS longitude_diff,
      k.latitude - p.latitude AS latitude_diff, k.cs IS NOT DISTINCT FROM p.cs AS same_callsign,
      k.on_ground IS NOT DISTINCT FROM p.on_ground AS same_ground
    FROM p FULL JOIN k ON p.aircraft = k.aircraft
    """
)
def match_feeds(spark, sf_dir):
    obs = view(spark, sf_dir, "obs").withColumnRenamed("callsign_raw", "callsign")
    newest = obs.groupBy("source").agg(F.max("fetched_at").alias("fetched_at"))
    # One row per feed by construction.
    rows = obs.join(F.broadcast(newest), ["source", "fetched_at"], "left_semi")
    return star.match_feeds(rows.where(POSITIONAL), rows.where(KEYED))


def airports(spark, sf_dir) -> DataFrame:
    """The airport dimension, written as a reference CSV and loaded from it."""
    path = new_folder(spark, "airports")
    view(spark, sf_dir, "dim_airports").write.option("header", True).csv(path)
    return reference.dim_airports(spark, path)


@query(
    """
    SELECT icao_code, iata_code, name, latitude_deg AS latitude, longitude_deg AS longitude
    FROM dim_airports WHERE icao_code IS NOT NULL
    """
)
def dim_airports(spark, sf_dir):
    return airports(spark, sf_dir)


IATA_MAP = """
    SELECT iata_code, min(icao_code) AS icao_code FROM dim_airports
    WHERE iata_code IS NOT NULL AND icao_code IS NOT NULL GROUP BY iata_code
"""


@query(IATA_MAP)
def iata_icao_map(spark, sf_dir):
    return star.iata_icao_map(airports(spark, sf_dir))


@query(
    f"""
    SELECT e.event_id, e.iata, m.icao_code AS iata_icao
    FROM (SELECT event_id, concat('I', CAST(user_id % 120 AS varchar(20))) AS iata FROM events) e
    LEFT JOIN ({IATA_MAP}) m ON m.iata_code = e.iata
    """
)
def iata_icao_join(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select("event_id", F.concat(F.lit("I"), (F.col("user_id") % 120).cast("string")).alias("iata"))
    return star.with_icao(rows, "iata", star.iata_icao_map(airports(spark, sf_dir)))


@query("SELECT icao24, registration, operator_icao, 'maker' AS manufacturer, CAST(NULL AS varchar) AS model FROM dim_aircraft")
def dim_aircraft(spark, sf_dir):
    path = new_folder(spark, "aircraft")
    rows = view(spark, sf_dir, "dim_aircraft").select(
        "icao24",
        "registration",
        F.col("operator_icao").alias("operatoricao"),
        F.lit("maker").alias("manufacturername"),
        F.lit(" ").alias("model"),
    )
    rows.write.option("header", True).csv(path)
    return reference.dim_aircraft(spark, path)


@query("SELECT icao_code, name, CAST(NULL AS varchar) AS iata_code, 'Testland' AS country FROM dim_airlines")
def dim_airlines(spark, sf_dir):
    path = new_folder(spark, "airlines")
    missing = F.lit(reference.AIRLINE_FILE_NULL)
    rows = view(spark, sf_dir, "dim_airlines").select(
        F.lit("1"), "name", missing, missing, F.lower("icao_code"), missing, F.lit("Testland"), F.lit("Y")
    )
    rows.toDF(*reference.AIRLINE_FILE_COLUMNS).write.option("escape", "\\").option("quote", '"').csv(path)
    return reference.dim_airlines(spark, path)


FACTS = f"""
    facts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY icao24, observed_at ORDER BY time_position DESC NULLS LAST, callsign ASC NULLS LAST,
          longitude ASC NULLS LAST, latitude ASC NULLS LAST, on_ground ASC NULLS LAST, true_track ASC NULLS LAST,
          vertical_rate ASC NULLS LAST) AS rn
      FROM (SELECT {POSITIONAL_ROW}, fetched_at AS observed_at FROM obs WHERE {POSITIONAL}
        UNION ALL SELECT {KEYED_ROW}, fetched_at FROM obs WHERE {KEYED} AND {HAS_POSITION}))
      WHERE rn = 1)
"""


@query(f"WITH {FACTS} {resolved('facts')}")
def build_fact_states(spark, sf_dir):
    return star.build_fact_states(documents(spark, sf_dir), *dims(spark, sf_dir))


@query(f"WITH {FACTS} {resolved('facts')}")
def append_fact_states(spark, sf_dir):
    """The same history from two landings with a day in common, the second of which reads new files only."""
    landing, facts, checkpoint = (new_folder(spark, x) for x in ("landing", "facts", "facts-checkpoint"))
    docs = documents(spark, sf_dir)
    day = F.to_date("fetched_at")
    middle = docs.agg(F.date_add(F.min(day), F.floor(F.date_diff(F.max(day), F.min(day)) / 2).cast("int"))).first()[0]
    for part in (day <= F.lit(middle), day >= F.lit(middle)):
        for source in (K.POSITIONAL_SOURCE, K.KEYED_SOURCE):
            mine = docs.where((F.col("source") == source) & part).select("payload", "fetched_at")
            snapshots.land_snapshots(mine, landing, source, "run", rebalance=True)
        stream_fact_states(spark, landing, facts, checkpoint).awaitTermination()
    return read_fact_states(spark, facts, *dims(spark, sf_dir))


@query(
    """
    SELECT icao24, registration, operator_icao, false AS is_stub FROM dim_aircraft
    UNION ALL SELECT DISTINCT icao24, CAST(NULL AS varchar), CAST(NULL AS varchar), true FROM positions
      WHERE icao24 NOT IN (SELECT icao24 FROM dim_aircraft)
    """
)
def stub_aircraft(spark, sf_dir):
    return star.stub_aircraft(view(spark, sf_dir, "positions"), view(spark, sf_dir, "dim_aircraft"))


@query(
    f"""
    WITH {FACTS}, states AS ({resolved('facts')})
    SELECT s.airline_icao, al.name, ac.registration, count(*) AS observations FROM states s
    LEFT JOIN dim_airlines al ON al.icao_code = s.airline_icao LEFT JOIN dim_aircraft ac ON ac.icao24 = s.icao24
    GROUP BY s.airline_icao, al.name, ac.registration
    """
)
def star_views(spark, sf_dir):
    aircraft, airlines = dims(spark, sf_dir)
    facts = star.build_fact_states(documents(spark, sf_dir), aircraft, airlines)
    star.create_star_views(facts, aircraft, airlines, airports(spark, sf_dir))
    return spark.sql(
        """
        SELECT s.airline_icao, al.name, ac.registration, count(*) AS observations FROM states s
        LEFT JOIN airlines al ON al.icao_code = s.airline_icao LEFT JOIN aircraft ac ON ac.icao24 = s.icao24
        GROUP BY s.airline_icao, al.name, ac.registration
        """
    )


WIDE = f"""
    wide AS (SELECT icao24 AS hex, nullif(trim(callsign_raw), '') AS callsign, concat('D-', icao24) AS registration,
      CAST(NULL AS varchar) AS aircraft_type, latitude, longitude, try_cast(alt_baro AS int) AS altitude_baro,
      CAST(NULL AS int) AS altitude_geom, CAST(NULL AS double) AS ground_speed, true_track AS track,
      CAST(trunc(vertical_rate) AS int) AS vertical_rate, lpad(CAST(id % 7777 AS varchar(20)), 4, '0') AS squawk,
      coalesce(make_timestamp(time_position * 1000000::BIGINT), fetched_at) AS seen_at, fetched_at AS collected_at
    FROM obs WHERE {KEYED} AND {HAS_POSITION})
"""


def wide(spark, sf_dir) -> DataFrame:
    return star.adsb_positions(documents(spark, sf_dir).where(F.col("source") == K.KEYED_SOURCE))


@query(f"WITH {WIDE} SELECT * FROM wide")
def adsb_positions(spark, sf_dir):
    return wide(spark, sf_dir)


@query(f"WITH {WIDE} SELECT * FROM wide")
def adsb_positions_parsed(spark, sf_dir):
    """The same from the fields that landing stored; no payload is read."""
    path = landed(spark, documents(spark, sf_dir), parse=True)
    return star.adsb_positions(snapshots.read_snapshots(spark, path, K.KEYED_SOURCE, parsed=True))


@query(
    f"""
    WITH {WIDE} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY hex, collected_at ORDER BY seen_at DESC, callsign ASC NULLS LAST, registration, aircraft_type,
        latitude, longitude, altitude_baro ASC NULLS LAST, altitude_geom, ground_speed, track ASC NULLS LAST,
        vertical_rate ASC NULLS LAST, squawk) AS rn FROM wide) WHERE rn = 1
    """
)
def dedup_overlaps(spark, sf_dir):
    return star.dedup_overlaps(wide(spark, sf_dir))


HAVERSINE = f"""2 * 3440.065e0 * asin(sqrt(pow(sin(radians(latitude - {K.CIRCLE_LAT}e0) / 2), 2)
      + cos(radians({K.CIRCLE_LAT}e0)) * cos(radians(latitude)) * pow(sin(radians(longitude - {K.CIRCLE_LON}e0) / 2), 2)))"""


@query(
    f"""
    SELECT id, icao24, round({HAVERSINE}, 6) AS distance_nm FROM positions
    WHERE {HAS_POSITION} AND {HAVERSINE} <= {K.CIRCLE_RADIUS_NM}
    """
)
def within_radius(spark, sf_dir):
    near = star.within_radius(view(spark, sf_dir, "positions"), K.CIRCLE_LAT, K.CIRCLE_LON, K.CIRCLE_RADIUS_NM)
    return near.select("id", "icao24", F.round("distance_nm", 6).alias("distance_nm"))


def by_cells(spark, rows: DataFrame) -> DataFrame:
    """``rows`` as a table in the order of the curve."""
    path = new_folder(spark, "cells")
    cells.write_cells(rows, path)
    return cells.read_cells(spark, path)


@query(
    f"""
    SELECT id, icao24, round({HAVERSINE}, 6) AS distance_nm FROM positions
    WHERE {HAS_POSITION} AND {HAVERSINE} <= {K.CIRCLE_RADIUS_NM}
    """
)
def within_radius_stored(spark, sf_dir):
    """The circle of ``within_radius``, asked of a table in the order of cells."""
    table = by_cells(spark, view(spark, sf_dir, "positions"))
    near = cells.within_radius(table, K.CIRCLE_LAT, K.CIRCLE_LON, K.CIRCLE_RADIUS_NM)
    return near.select("id", "icao24", F.round("distance_nm", 6).alias("distance_nm"))


#: Moved so far east, positions about the middle of the box lie on both sides of the date line.
EASTWARD = 180.0 - (K.WEST + K.EAST) / 2
MOVED_BOX = (K.SOUTH + 0.5, K.NORTH - 0.5, 179.0, -178.5)


@query(
    f"""
    WITH moved AS (
      SELECT id, CAST(latitude AS DOUBLE) AS latitude, CASE WHEN longitude + {EASTWARD}e0 >= 180
        THEN longitude + {EASTWARD}e0 - 360 ELSE longitude + {EASTWARD}e0 END AS longitude FROM positions)
    SELECT id, latitude, longitude FROM moved
    WHERE latitude BETWEEN {MOVED_BOX[0]} AND {MOVED_BOX[1]} AND (longitude >= {MOVED_BOX[2]} OR longitude <= {MOVED_BOX[3]})
    """
)
def box_across_date_line(spark, sf_dir):
    """A box across the date line, asked of a table in the order of cells."""
    east = F.col("longitude") + F.lit(EASTWARD)
    rows = view(spark, sf_dir, "positions").select(
        "id", F.col("latitude").cast("double").alias("latitude"), F.when(east >= 180, east - 360).otherwise(east).alias("longitude")
    )
    return cells.in_box(by_cells(spark, rows), *MOVED_BOX)


def stored(spark, sf_dir) -> DataFrame:
    """The flattened feed as a table: payloads are parsed once, and look-ups reach its files as filters."""
    return materialise(wide(spark, sf_dir), "adsb-positions")


@query(f"WITH {WIDE} SELECT * FROM wide WHERE lower(hex) = '000008'")
def lookup_hex(spark, sf_dir):
    rows = stored(spark, sf_dir).withColumnRenamed("hex", "icao24")
    return star.lookup(rows, icao24="000008").withColumnRenamed("icao24", "hex")


@query(f"WITH {WIDE} SELECT * FROM wide WHERE callsign LIKE 'CLI%'")
def lookup_callsign(spark, sf_dir):
    return star.lookup(stored(spark, sf_dir), callsign="CLI*")


@query(f"WITH {WIDE} SELECT * FROM wide WHERE registration = 'D-000007'")
def lookup_registration(spark, sf_dir):
    return star.lookup(stored(spark, sf_dir), registration="D-000007")


@query(f"WITH {WIDE} SELECT * FROM wide WHERE squawk = '0042'")
def lookup_squawk(spark, sf_dir):
    return star.lookup(stored(spark, sf_dir), squawk="0042")


def leg_documents(spark, sf_dir) -> DataFrame:
    """Orders as stored flight-leg calls, at most 256 legs per document (order keys are unique)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    leg = F.struct(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("icao24"),
        F.concat(F.substring("o_orderpriority", 3, 3), F.lit(" ")).alias("callsign"),
        F.col("o_orderkey").alias("firstSeen"),
        (F.col("o_orderkey") + 3600).alias("lastSeen"),
        F.concat(F.lit("ED"), F.col("o_orderstatus")).alias("estDepartureAirport"),
        (F.col("o_custkey") % 5000).alias("estDepartureAirportHorizDistance"),
    )
    page = F.floor(F.col("o_orderkey") / PAGE_ROWS)
    query_params = F.struct(F.lit("EDDF").alias("airport"), F.col("page").alias("begin"), (F.col("page") + 1).alias("end"))
    return (
        orders.select(page.alias("page"), leg.alias("leg"))
        .groupBy("page")
        .agg(F.collect_list("leg").alias("flights"))
        .select(
            F.to_json(
                F.struct(
                    F.lit("departures").alias("endpoint"),
                    query_params.alias("query_params"),
                    F.size("flights").alias("flight_count"),
                    "flights",
                )
            ).alias("payload"),
            F.lit("2024-01-30 00:00:00").cast("timestamp").alias("fetched_at"),
        )
    )


@query(
    """
    SELECT 'departures' AS endpoint, 'EDDF' AS query_airport, o_orderkey // 256 AS query_begin,
      o_orderkey // 256 + 1 AS query_end, TIMESTAMP '2024-01-30 00:00:00' AS collected_at,
      lpad(CAST(o_custkey AS varchar(20)), 6, '0') AS icao24, trim(substr(o_orderpriority, 3, 3)) AS callsign,
      o_orderkey AS first_seen, o_orderkey + 3600 AS last_seen, concat('ED', o_orderstatus) AS departure_airport,
      CAST(NULL AS varchar) AS arrival_airport, o_custkey % 5000 AS departure_distance_m,
      CAST(NULL AS bigint) AS arrival_distance_m
    FROM orders
    """
)
def flight_legs(spark, sf_dir):
    return star.flight_legs(leg_documents(spark, sf_dir))
