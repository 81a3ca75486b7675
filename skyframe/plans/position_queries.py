"""Landing, unification, refresh and live-map queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.columns import instant
from skyframe.operators import live, unify
from skyframe.plans.registry import query
from skyframe.plans.standins import raw_documents, view
from skyframe.session import new_folder
from skyframe.sources import positions as table
from skyframe.sources import snapshots
from skyframe.streaming.landing import FEED_TRANSFORMS, stream_land, trim_payload
from skyframe.streaming.latest import read_latest, stream_latest
from skyframe.streaming.refresh import stream_refresh

RUN = "run_check"
BOX = f"latitude BETWEEN {K.SOUTH} AND {K.NORTH} AND longitude BETWEEN {K.WEST} AND {K.EAST}"
KEYED, POSITIONAL = f"source = '{K.KEYED_SOURCE}'", f"source = '{K.POSITIONAL_SOURCE}'"
NEWEST = f"{KEYED} AND fetched_at = (SELECT max(fetched_at) FROM obs WHERE {KEYED})"

KEYED_ROW = """icao24, nullif(trim(callsign_raw), '') AS callsign, time_position, CAST(longitude AS REAL) AS longitude,
  CAST(latitude AS REAL) AS latitude, on_ground, true_track, vertical_rate"""
POSITIONAL_ROW = KEYED_ROW.replace("nullif(trim(callsign_raw), '')", "callsign_raw")
HAS_POSITION = "longitude IS NOT NULL AND latitude IS NOT NULL"


def documents(spark, sf_dir) -> DataFrame:
    return raw_documents(view(spark, sf_dir, "obs"))


def one_per_call(spark, sf_dir) -> DataFrame:
    """Observations with one row per aircraft and call, as a feed answers."""
    w = Window.partitionBy("source", "fetched_at", "icao24").orderBy(F.desc("id"))
    ranked = view(spark, sf_dir, "obs").withColumn("_rank", F.row_number().over(w))
    return ranked.where("_rank = 1").drop("_rank")


def landed(spark, docs: DataFrame, parse: bool = False, transforms: dict | None = None) -> str:
    """Land both feeds into a new folder and return it."""
    path = new_folder(spark, "landing")
    for source in (K.POSITIONAL_SOURCE, K.KEYED_SOURCE):
        mine = docs.where(F.col("source") == source).select("payload", "fetched_at")
        snapshots.land_snapshots(mine, path, source, RUN, (transforms or {}).get(source), rebalance=True, parse=parse)
    return path


@query(
    """
    SELECT source, fetched_at, 'run_check' AS pipeline_run_id, count(DISTINCT id // 256) AS documents,
      count(DISTINCT id // 256) AS stamped
    FROM obs GROUP BY source, fetched_at
    """
)
def land_snapshots(spark, sf_dir):
    path = landed(spark, documents(spark, sf_dir))
    return (
        snapshots.read_snapshots(spark, path)
        .groupBy("source", "fetched_at", "pipeline_run_id")
        .agg(F.count("*").alias("documents"), F.count("load_date").alias("stamped"))
    )


@query(
    f"""
    SELECT fetched_at, count(DISTINCT id // 256) AS documents, count(*) AS aircraft
    FROM obs WHERE {KEYED} GROUP BY fetched_at
    """
)
def read_snapshots(spark, sf_dir):
    path = landed(spark, documents(spark, sf_dir))
    docs = snapshots.read_snapshots(spark, path, K.KEYED_SOURCE)
    size = F.size(F.from_json("payload", "ac array<string>")["ac"])
    return (
        docs.groupBy("fetched_at")
        .agg(F.count("*").alias("documents"), F.sum(size).alias("aircraft"))
        .orderBy(F.desc("fetched_at"))
    )


#: Payloads and why they are refused; None where they are stored.
GUARDED = [
    ("{bad", "invalid_json"),
    ("[]", "empty"),
    ("{ }", "empty"),
    ("null", "empty"),
    ("5", "unexpected_type"),
    ('{"a":1,"a":2}', None),
    ('{"a":NaN}', None),
    ('{"a":1} xx', "invalid_json"),
    ('{"a":1}}', "invalid_json"),
    ('{"a":1},"b":2', "invalid_json"),
    ('[{"a":1}', "invalid_json"),
    ('[{"a":{"b":[1,2]}},{}]', None),
]


@query(
    f"""
    SELECT event_id, CASE event_id % {len(GUARDED) + 2}
      {" ".join(f"WHEN {i} THEN {f"'{reason}'" if reason else "NULL"}" for i, (_, reason) in enumerate(GUARDED))} END AS reason
    FROM events
    """
)
def parse_guard(spark, sf_dir):
    texts = F.array(*[F.lit(t) for t, _ in GUARDED])
    slot = (F.col("event_id") % (len(GUARDED) + 2)).cast("int")
    payload = F.coalesce(F.get(texts, slot), F.col("props"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return snapshots.parse_guard(events.select("event_id", payload.alias("payload"))).select("event_id", "reason")


@query("SELECT source, fetched_at, count(DISTINCT id // 256) AS documents FROM obs GROUP BY source, fetched_at")
def land_duplicates(spark, sf_dir):
    """Documents landed a second time, some of them twice in one call, are skipped by key."""
    path, docs = new_folder(spark, "landing"), documents(spark, sf_dir)
    for again in (docs, docs.unionByName(docs.where(F.col("fetched_at") > "2024-01-10"))):
        for source in (K.POSITIONAL_SOURCE, K.KEYED_SOURCE):
            mine = again.where(F.col("source") == source).select("payload", "fetched_at")
            snapshots.land_snapshots(mine, path, source, RUN, key=("payload", "fetched_at"), rebalance=True)
    return snapshots.read_snapshots(spark, path).groupBy("source", "fetched_at").agg(F.count("*").alias("documents"))


@query(
    f"""
    SELECT icao24, CAST(latitude AS REAL) AS latitude, CAST(longitude AS REAL) AS longitude, fetched_at
    FROM obs WHERE {KEYED} AND {BOX}
    """
)
def bbox_trim(spark, sf_dir):
    docs = documents(spark, sf_dir).where(F.col("source") == K.KEYED_SOURCE)
    rows = unify.map_keyed(docs.transform(trim_payload))
    return rows.select("icao24", "latitude", "longitude", "fetched_at")


@query(
    f"""
    SELECT icao24, CAST(latitude AS REAL) AS latitude, CAST(longitude AS REAL) AS longitude, fetched_at
    FROM obs WHERE {KEYED} AND {BOX}
    """
)
def bbox_trim_parsed(spark, sf_dir):
    """Trimmed at landing, where payloads are parsed once, and mapped from the stored fields."""
    path = landed(spark, documents(spark, sf_dir), parse=True, transforms=FEED_TRANSFORMS)
    rows = unify.map_keyed(snapshots.read_snapshots(spark, path, K.KEYED_SOURCE, parsed=True))
    return rows.select("icao24", "latitude", "longitude", "fetched_at")


@query(
    f"""
    SELECT fetched_at, count(*) AS ac_total, count(*) FILTER ({BOX}) AS ac_kept
    FROM obs WHERE {KEYED} GROUP BY fetched_at
    """
)
def bbox_trim_counts(spark, sf_dir):
    docs = documents(spark, sf_dir).where(F.col("source") == K.KEYED_SOURCE)
    sums = [F.sum(c).alias(c) for c in ("ac_total", "ac_kept")]
    return unify.bbox_trim(docs).groupBy("fetched_at").agg(*sums)


@query(f"SELECT {POSITIONAL_ROW}, fetched_at FROM obs WHERE {POSITIONAL}")
def map_positional(spark, sf_dir):
    docs = documents(spark, sf_dir).where(F.col("source") == K.POSITIONAL_SOURCE)
    return unify.map_positional(docs).drop("source")


@query(f"SELECT {KEYED_ROW}, fetched_at FROM obs WHERE {KEYED} AND {HAS_POSITION}")
def map_keyed(spark, sf_dir):
    docs = documents(spark, sf_dir).where(F.col("source") == K.KEYED_SOURCE)
    return unify.map_keyed(docs).drop("source")


@query(
    f"""
    SELECT icao24, round(vertical_rate * 0.00508e0, 9) AS vertical_rate, fetched_at
    FROM obs WHERE {KEYED} AND {HAS_POSITION}
    """
)
def unit_normalise(spark, sf_dir):
    docs = documents(spark, sf_dir).where(F.col("source") == K.KEYED_SOURCE)
    rows = unify.map_keyed(docs, metric_rate=True)
    return rows.select("icao24", F.round("vertical_rate", 9).alias("vertical_rate"), "fetched_at")


@query(
    f"""
    SELECT {POSITIONAL_ROW}, fetched_at AS updated_at FROM obs WHERE {POSITIONAL}
    UNION ALL SELECT {KEYED_ROW}, fetched_at FROM obs WHERE {KEYED} AND {HAS_POSITION}
    """
)
def unify_positions(spark, sf_dir):
    return unify.unify_positions(documents(spark, sf_dir)).drop("created_at")


@query(
    f"""
    SELECT {POSITIONAL_ROW}, fetched_at AS updated_at FROM obs WHERE {POSITIONAL}
    UNION ALL SELECT {KEYED_ROW}, fetched_at FROM obs WHERE {KEYED} AND {HAS_POSITION}
    """
)
def unify_positions_parsed(spark, sf_dir):
    """Both feeds from the fields that landing stored; no payload is read."""
    path = landed(spark, documents(spark, sf_dir), parse=True)
    return unify.unify_positions(snapshots.read_snapshots(spark, path, parsed=True)).drop("created_at")


@query(
    """
    SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 2 THEN ts - INTERVAL '2' HOUR ELSE ts END AS fetched_at
    FROM events
    """
)
def normalise_fetched_at(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    suffix = F.element_at(
        F.array(*[F.lit(t) for t in ("Z", "+00:00", "+02:00", "", " at noon")]), (F.col("event_id") % 5 + 1).cast("int")
    )
    return events.select("event_id", instant(F.concat(iso, suffix)).alias("fetched_at"))


@query(
    f"""
    SELECT source, fetched_at, count(DISTINCT id // 256) AS documents FROM obs WHERE {NEWEST}
    GROUP BY source, fetched_at
    """
)
def freshest_snapshot(spark, sf_dir):
    newest = unify.freshest_snapshot(documents(spark, sf_dir))
    return newest.groupBy("source", "fetched_at").agg(F.count("*").alias("documents"))


CURRENT_SQL = f"""
    SELECT icao24, nullif(trim(callsign_raw), '') AS callsign, CAST(longitude AS REAL) AS longitude,
      CAST(latitude AS REAL) AS latitude, on_ground, true_track, vertical_rate, fetched_at AS updated_at
    FROM obs WHERE {NEWEST} AND {HAS_POSITION}
"""


@query(CURRENT_SQL)
def current_aircraft(spark, sf_dir):
    """Which aircraft are where right now: newest call, guard, mapping, live-map shape."""
    docs = snapshots.read_snapshots(spark, landed(spark, documents(spark, sf_dir)))
    return live.current_aircraft(unify.unify_positions(unify.freshest_snapshot(docs)))


ONE_PER_CALL = "SELECT *, row_number() OVER (PARTITION BY source, fetched_at, icao24 ORDER BY id DESC) AS rn FROM obs"
TABLE_SQL = f"""
    SELECT {KEYED_ROW}, fetched_at AS updated_at
    FROM ({ONE_PER_CALL}) WHERE rn = 1 AND {NEWEST} AND {HAS_POSITION}
"""


@query(TABLE_SQL)
def refresh_positions(spark, sf_dir):
    path = landed(spark, raw_documents(one_per_call(spark, sf_dir)))
    table.refresh_positions(snapshots.read_snapshots(spark, path), "map1")
    return table.read_positions(spark, "map1").drop("id", "created_at")


@query(
    f"""
    SELECT icao24, nullif(trim(callsign_raw), '') AS callsign, CAST(longitude AS REAL) AS longitude,
      CAST(latitude AS REAL) AS latitude, on_ground, true_track, vertical_rate, fetched_at AS updated_at
    FROM ({ONE_PER_CALL}) WHERE rn = 1 AND {NEWEST} AND {HAS_POSITION}
    """
)
def read_positions(spark, sf_dir):
    docs = snapshots.read_snapshots(spark, landed(spark, raw_documents(one_per_call(spark, sf_dir))))
    table.refresh_positions(docs, "q_map1")
    return live.current_aircraft(table.read_positions(spark, "q_map1"))


@query(f"SELECT * FROM positions WHERE {HAS_POSITION}")
def null_position_filter(spark, sf_dir):
    return live.positioned(view(spark, sf_dir, "positions"))


@query(
    """
    SELECT id, vertical_rate,
      CASE WHEN vertical_rate IS NULL OR abs(vertical_rate) < 1 THEN 'Level'
           WHEN vertical_rate > 0 THEN 'Climbing' ELSE 'Descending' END AS flight_phase,
      CASE WHEN vertical_rate IS NULL OR abs(vertical_rate) < 1 THEN ''
           WHEN vertical_rate > 0 THEN '▲' ELSE '▼' END AS arrow
    FROM positions
    """
)
def flight_phase(spark, sf_dir):
    rows = live.with_flight_phase(view(spark, sf_dir, "positions"))
    return rows.select("id", "vertical_rate", "flight_phase", "arrow")


@query(
    f"""
    WITH m AS (
      SELECT icao24, latitude, longitude, coalesce(nullif(callsign, ''), nullif(icao24, ''), 'Unknown') AS label,
        CASE WHEN on_ground THEN 'On ground' ELSE 'Airborne' END AS ground_text,
        CASE WHEN vertical_rate IS NULL OR abs(vertical_rate) < 1 THEN 'Level'
             WHEN vertical_rate > 0 THEN 'Climbing' ELSE 'Descending' END AS trend,
        CASE WHEN vertical_rate IS NULL OR abs(vertical_rate) < 1 THEN ''
             WHEN vertical_rate > 0 THEN '▲' ELSE '▼' END AS arrow,
        coalesce(true_track, 0) AS heading,
        CASE WHEN on_ground THEN '{K.GROUND_COLOR}' ELSE '{K.AIRBORNE_COLOR}' END AS color
      FROM positions WHERE {HAS_POSITION})
    SELECT *, concat(label, ' — ', ground_text, ' — ', trend) AS tooltip FROM m
    """
)
def marker_columns(spark, sf_dir):
    return live.marker_columns(live.current_aircraft(view(spark, sf_dir, "positions")))


LATEST = """
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY icao24, callsign ORDER BY time_position DESC NULLS FIRST, id DESC) AS rn FROM positions) WHERE rn = 1)
"""


@query(f"WITH {LATEST} SELECT * EXCLUDE (rn) FROM latest")
def latest_per_aircraft(spark, sf_dir):
    return live.latest_per_aircraft(view(spark, sf_dir, "positions"))


@query(f"WITH {LATEST} SELECT * EXCLUDE (rn) FROM latest")
def stream_latest_per_aircraft(spark, sf_dir):
    """All positions as a stream of three landings, whose times overlap, so that many rows come late."""
    rows = view(spark, sf_dir, "positions")
    path, changes, offsets = (new_folder(spark, n) for n in ("positions", "changes", "offsets"))
    for part in (0, 1, 2):
        rows.where(F.pmod(F.hash("id"), F.lit(3)) == part).write.mode("append").parquet(path)
        landed_rows = spark.readStream.schema(rows.schema).parquet(path)
        stream_latest(landed_rows, changes, offsets).awaitTermination()
    return read_latest(spark, changes, rows.schema)


@query(
    f"""
    WITH {LATEST}
    SELECT count(*) AS aircraft, count(*) FILTER (on_ground = false) AS in_flight,
      max(time_position) AS newest_position,
      strftime(make_timestamp(max(time_position) * 1000000::BIGINT), '%Y-%m-%d %H:%M UTC') AS newest_position_text
    FROM latest
    """
)
def live_kpis(spark, sf_dir):
    return live.live_kpis(live.latest_per_aircraft(view(spark, sf_dir, "positions")))


@query(
    f"""
    SELECT count(*) AS aircraft, concat(CAST(count(*) AS varchar), ' aircraft — last updated: ',
      coalesce(strftime(max(updated_at), '%Y-%m-%d %H:%M:%S UTC'), 'n/a')) AS status
    FROM positions WHERE {HAS_POSITION}
    """
)
def status_line(spark, sf_dir):
    return live.status_line(live.current_aircraft(view(spark, sf_dir, "positions")))


@query(
    f"""
    WITH {LATEST}
    SELECT icao24 AS "ICAO24", callsign AS "Callsign", latitude AS "Latitude", longitude AS "Longitude",
      on_ground AS "On Ground", true_track AS "Track (°)", vertical_rate AS "Vertical Rate (m/s)",
      make_timestamp(time_position * 1000000::BIGINT) AS "Time Position (UTC)"
    FROM latest ORDER BY callsign ASC NULLS LAST
    """
)
def position_display(spark, sf_dir):
    return live.position_display(live.latest_per_aircraft(view(spark, sf_dir, "positions")))


@query(
    """
    SELECT icao24, time_position, count(*) AS copies FROM positions
    WHERE icao24 IS NOT NULL AND time_position IS NOT NULL GROUP BY icao24, time_position HAVING count(*) > 1
    """
)
def duplicate_keys(spark, sf_dir):
    return live.duplicate_keys(view(spark, sf_dir, "positions"))


STREAM_ROW = "callsign, time_position, longitude, latitude, on_ground, true_track, vertical_rate"


@query(
    f"""
    SELECT source, {POSITIONAL_ROW} FROM obs WHERE {POSITIONAL}
    UNION ALL SELECT source, {KEYED_ROW} FROM obs WHERE {KEYED} AND {BOX}
    """,
    name="stream_land",
)
def stream_land_feeds(spark, sf_dir):
    """Both feeds landed as streams from a drop folder; the keyed one is trimmed on the way."""
    docs = documents(spark, sf_dir)
    path = new_folder(spark, "stream-landing")
    rows = None
    for source, mapping in ((K.POSITIONAL_SOURCE, unify.map_positional), (K.KEYED_SOURCE, unify.map_keyed)):
        drop = new_folder(spark, "drop")
        docs.where(F.col("source") == source).select("payload").write.text(drop)
        stream_land(
            spark, drop, f"{path}/{source}", source, RUN, new_folder(spark, "offsets"), {"availableNow": True}
        ).awaitTermination()
        got = mapping(snapshots.read_snapshots(spark, f"{path}/{source}")).select(
            "source", "icao24", *STREAM_ROW.split(", ")
        )
        rows = got if rows is None else rows.unionByName(got)
    return rows


@query(
    f"""
    SELECT source, count(*) AS documents FROM (
      SELECT DISTINCT source, fetched_at, id // 256 AS page FROM obs
      UNION ALL SELECT DISTINCT source, fetched_at, id // 256 FROM obs WHERE {KEYED}
    ) GROUP BY source
    """
)
def stream_land_shared(spark, sf_dir):
    """Two streams, a batch and retention on one folder: nothing is lost, nothing in the way."""
    docs, path = documents(spark, sf_dir), new_folder(spark, "shared-landing")
    for source in (K.POSITIONAL_SOURCE, K.KEYED_SOURCE):
        drop, offsets = new_folder(spark, "drop"), new_folder(spark, "offsets")
        docs.where(F.col("source") == source).select("payload").write.text(drop)
        for _ in range(2):
            stream_land(spark, drop, path, source, RUN, offsets, {"availableNow": True}).awaitTermination()
    keyed = docs.where(F.col("source") == K.KEYED_SOURCE).select("payload", "fetched_at")
    # The streams stamp the time of their files, which is now, and so does this batch.
    snapshots.land_snapshots(keyed.withColumn("fetched_at", F.current_timestamp()), path, K.KEYED_SOURCE, RUN)
    old = keyed.withColumn("fetched_at", F.lit("2000-01-01").cast("timestamp"))
    snapshots.land_snapshots(old, path, K.KEYED_SOURCE, RUN)
    snapshots.drop_expired(spark, path)
    return snapshots.read_snapshots(spark, path).groupBy("source").agg(F.count("*").alias("documents"))


@query(TABLE_SQL, name="stream_refresh")
def stream_refresh_table(spark, sf_dir):
    path = landed(spark, raw_documents(one_per_call(spark, sf_dir)))
    stream_refresh(
        spark, {"both": path}, "map1", new_folder(spark, "offsets"), trigger={"availableNow": True}
    ).awaitTermination()
    return table.read_positions(spark, "map1").drop("id", "created_at")


AS_OF = "2024-01-31 00:01:00"


@query(
    f"""
    SELECT source, max(fetched_at) AS newest,
      CAST(epoch_ms(TIMESTAMP '{AS_OF}' - max(fetched_at)) AS double) / 1000 AS age_seconds,
      epoch_ms(TIMESTAMP '{AS_OF}' - max(fetched_at)) <= {K.LANDING_STALE_SECONDS * 1000} AS healthy
    FROM obs GROUP BY source
    """
)
def staleness(spark, sf_dir):
    now = F.lit(AS_OF).cast("timestamp")
    return live.staleness(documents(spark, sf_dir), "fetched_at", K.LANDING_STALE_SECONDS, ("source",), now)


RETAIN_AS_OF = "2024-01-30 12:00:00"


@query(
    f"""
    SELECT source, fetched_at, count(DISTINCT id // 256) AS documents FROM obs
    WHERE fetched_at >= TIMESTAMP '{RETAIN_AS_OF}' - INTERVAL '{K.RETENTION_HOURS}' HOUR GROUP BY source, fetched_at
    """
)
def retention(spark, sf_dir):
    path = landed(spark, documents(spark, sf_dir))
    now = datetime.fromisoformat(RETAIN_AS_OF).replace(tzinfo=timezone.utc)
    snapshots.drop_expired(spark, path, now)
    kept = snapshots.unexpired(snapshots.read_snapshots(spark, path), F.lit(RETAIN_AS_OF).cast("timestamp"))
    return kept.groupBy("source", "fetched_at").agg(F.count("*").alias("documents"))


@query(TABLE_SQL)
def late_data(spark, sf_dir):
    """The freshest call is landed and shown first; all older ones arrive late and change nothing."""
    docs, path, offsets = raw_documents(one_per_call(spark, sf_dir)), new_folder(spark, "landing"), new_folder(spark, "offsets")
    newest = unify.newest_call(docs).first()["fetched_at"]
    for part in (docs.where(F.col("fetched_at") == F.lit(newest)), docs.where(F.col("fetched_at") < F.lit(newest))):
        for source in (K.POSITIONAL_SOURCE, K.KEYED_SOURCE):
            mine = part.where(F.col("source") == source).select("payload", "fetched_at")
            snapshots.land_snapshots(mine, path, source, RUN)
        stream_refresh(spark, {"both": path}, "q_map1", offsets, trigger={"availableNow": True}).awaitTermination()
    return table.read_positions(spark, "q_map1").drop("id", "created_at")
