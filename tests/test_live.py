"""Live-map rules on hand-written rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.operators import live

SCHEMA = (
    "id long, icao24 string, callsign string, time_position int, longitude float, latitude float, "
    "on_ground boolean, true_track double, vertical_rate double, updated_at timestamp"
)
T = datetime(2024, 1, 1, 10, 30, 5)


def table(spark, *rows):
    base = {"icao24": "a", "callsign": "C", "time_position": 1, "longitude": 9.0, "latitude": 48.0, "on_ground": False, "true_track": 1.0, "vertical_rate": 0.0, "updated_at": T}
    names = [p.split()[0] for p in SCHEMA.split(", ")]
    full = [{"id": i, **base, **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], SCHEMA)


def test_null_time_counts_as_newest_then_higher_id(spark):
    df = table(
        spark,
        {"time_position": 5},
        {"time_position": None},
        {"callsign": None, "time_position": 7},
        {"callsign": None, "time_position": 7},
    )
    assert sorted(r["id"] for r in live.latest_per_aircraft(df).collect()) == [1, 3]


@pytest.mark.parametrize(
    "rate, phase, arrow",
    [(None, "Level", ""), (0.99, "Level", ""), (-0.99, "Level", ""), (1.0, "Climbing", "▲"), (-1.0, "Descending", "▼")],
)
def test_phase(spark, rate, phase, arrow):
    row = live.with_flight_phase(table(spark, {"vertical_rate": rate})).first()
    assert (row["flight_phase"], row["arrow"]) == (phase, arrow)


def test_markers(spark):
    df = table(
        spark,
        {"callsign": "", "on_ground": None, "true_track": None},
        {"callsign": None, "icao24": "", "on_ground": True, "vertical_rate": 2.0},
        {"callsign": "   "},
        {"latitude": None},
    )
    rows = live.marker_columns(live.current_aircraft(df)).collect()
    assert [r["label"] for r in rows] == ["a", "Unknown", "   "]
    assert rows[0]["heading"] == 0.0 and rows[0]["color"] == K.AIRBORNE_COLOR
    assert rows[0]["tooltip"] == "a — Airborne — Level"
    assert rows[1]["tooltip"] == "Unknown — On ground — Climbing" and rows[1]["color"] == K.GROUND_COLOR


def test_counts_of_the_two_maps(spark):
    df = table(spark, {"latitude": None}, {"icao24": "b", "on_ground": None}, {"icao24": "b", "on_ground": None})
    kpis = live.live_kpis(live.latest_per_aircraft(df)).first()
    assert (kpis["aircraft"], kpis["in_flight"]) == (2, 1)
    assert kpis["newest_position_text"] == "1970-01-01 00:00 UTC"
    assert live.status_line(live.current_aircraft(df)).first()["status"] == "2 aircraft — last updated: 2024-01-01 10:30:05 UTC"


def test_status_without_rows_or_times(spark):
    assert live.status_line(table(spark, {}).limit(0)).first()["status"] == "0 aircraft — last updated: n/a"
    assert live.status_line(table(spark, {"updated_at": None})).first()["status"] == "1 aircraft — last updated: n/a"


def test_display_order_and_headers(spark):
    df = table(spark, {"callsign": None}, {"callsign": "B"}, {"callsign": "A", "time_position": None})
    shown = live.position_display(df)
    assert shown.columns == list(K.DISPLAY_HEADERS.values())
    assert [r["Callsign"] for r in shown.collect()] == ["A", "B", None]


def test_repeated_keys_ignore_nulls(spark):
    df = table(spark, {}, {}, {"time_position": None}, {"time_position": None}, {"icao24": None}, {"icao24": None})
    assert [(r["icao24"], r["copies"]) for r in live.duplicate_keys(df).collect()] == [("a", 2)]


def test_staleness(spark):
    df = table(spark, {}, {"updated_at": datetime(2024, 1, 1, 10, 30)})
    at = lambda s: F.lit(datetime(2024, 1, 1, 10, 30, s))
    assert live.staleness(df, "updated_at", K.REFRESH_STALE_SECONDS, now=at(35)).first()["healthy"] is True
    row = live.staleness(df, "updated_at", K.REFRESH_STALE_SECONDS, now=at(36)).first()
    assert row["healthy"] is False and row["age_seconds"] == 31.0
    assert live.staleness(df.limit(0), "updated_at", 30, now=at(1)).first()["healthy"] is False
