"""Mapping of both feeds, on hand-written payloads."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.columns import instant
from skyframe.operators import unify
from skyframe.sources import snapshots

T0 = datetime(2024, 1, 1)


def keyed(spark, *aircraft, now=1704067200000, **top):
    payload = json.dumps({"now": now, "ac": list(aircraft), **top})
    return spark.createDataFrame([(payload, K.KEYED_SOURCE, T0)], "payload string, source string, fetched_at timestamp")


def positional(spark, payload):
    return spark.createDataFrame(
        [(payload, K.POSITIONAL_SOURCE, T0)], "payload string, source string, fetched_at timestamp"
    )


BASE = {"hex": "a1", "lat": 48.5, "lon": 9.25}


def one(spark, **fields):
    return unify.map_keyed(keyed(spark, {**BASE, **fields})).first()


@pytest.mark.parametrize(
    "fields, rate",
    [
        ({"baro_rate": 640, "geom_rate": 1}, 640.0),
        ({"geom_rate": 320}, 320.0),
        ({"baro_rate": None, "geom_rate": 320}, None),
        ({}, None),
    ],
)
def test_rate_prefers_a_present_barometric_field(spark, fields, rate):
    assert one(spark, **fields)["vertical_rate"] == rate


def test_null_rate_can_fall_back(spark):
    docs = keyed(spark, {**BASE, "baro_rate": None, "geom_rate": 320})
    assert unify.map_keyed(docs, null_falls_back=True).first()["vertical_rate"] == 320.0


def test_metric_rate(spark):
    docs = keyed(spark, {**BASE, "baro_rate": 1000})
    assert unify.map_keyed(docs, metric_rate=True).first()["vertical_rate"] == pytest.approx(5.08)


@pytest.mark.parametrize("alt, ground", [("ground", True), (1200, False), (None, False)])
def test_ground_flag(spark, alt, ground):
    assert one(spark, alt_baro=alt)["on_ground"] is ground


def test_ground_flag_without_altitude(spark):
    assert one(spark)["on_ground"] is False


@pytest.mark.parametrize("flight, callsign", [("DLH1  ", "DLH1"), ("   ", None), ("\t", None), ("", None), (None, None), (" X ", "X")])
def test_keyed_callsign(spark, flight, callsign):
    assert one(spark, flight=flight)["callsign"] == callsign


@pytest.mark.parametrize("seen, expected", [(0, 1704067200), (1.5, 1704067198), (0.2, 1704067199), (None, None)])
def test_time_position_truncates(spark, seen, expected):
    assert one(spark, seen_pos=seen)["time_position"] == expected


def test_time_position_truncates_toward_zero_before_the_epoch(spark):
    docs = keyed(spark, {**BASE, "seen_pos": 1.5}, now=1000)
    assert unify.map_keyed(docs).first()["time_position"] == 0


def test_keyed_drops_unpositioned(spark):
    docs = keyed(spark, BASE, {"hex": "b"}, {"hex": "c", "lat": None, "lon": 9})
    assert [r["icao24"] for r in unify.map_keyed(docs).collect()] == ["a1"]


@pytest.mark.parametrize("payload", ['{"now": 1}', '{"now": 1, "ac": []}', '{"now": 1, "ac": {"x": 1}}'])
def test_keyed_without_a_list_gives_no_rows(spark, payload):
    docs = keyed(spark).withColumn("payload", F.lit(payload))
    assert unify.map_keyed(docs).count() == 0


def test_positional_maps_as_is(spark):
    vector = ["3c675a", "DLH9LF  ", "Germany", 1704067200, 1704067201, 8.5, 50.125, 900.5, False, 80.1, 270.5, -3.25, None]
    spaces = ["x", "   ", "Y", None, None, None, None, None, True, None, None, None, None]
    rows = unify.map_positional(positional(spark, json.dumps({"states": [vector, spaces]}))).collect()
    first = rows[0]
    assert (first["icao24"], first["callsign"], first["time_position"]) == ("3c675a", "DLH9LF  ", 1704067200)
    assert (first["longitude"], first["latitude"], first["on_ground"]) == (8.5, 50.125, False)
    assert (first["true_track"], first["vertical_rate"]) == (270.5, -3.25)
    assert rows[1]["callsign"] == "   " and rows[1]["longitude"] is None and rows[1]["on_ground"] is True


def test_coordinates_are_single_precision(spark):
    schema = unify.map_keyed(keyed(spark, BASE)).schema
    assert schema["latitude"].dataType.simpleString() == schema["longitude"].dataType.simpleString() == "float"


@pytest.mark.parametrize(
    "payload, no_list, bad",
    [
        ('{"states": null}', 1, 0),
        ('{"time": 1}', 1, 0),
        ('{"states": []}', 0, 0),
        ('{"states": [["a", "b"]]}', 0, 1),
        ('{"states": [null]}', 0, 1),
    ],
)
def test_faults(spark, payload, no_list, bad):
    row = unify.snapshot_faults(positional(spark, payload)).first()
    assert (row["documents"], row["no_list"], row["bad_vectors"]) == (1, no_list, bad)


def test_trim_keeps_inclusive_edges_and_everything_else(spark):
    edge = {"hex": "e", "lat": 47.0, "lon": 15, "nested": {"a": [1, "x"]}, "note": "quote \" and é"}
    out = {"hex": "o", "lat": 46.999, "lon": 10}
    docs = keyed(spark, edge, out, {"hex": "n"}, {"hex": "t", "lat": "high", "lon": 9}, msg="No error", total=4)
    row = unify.bbox_trim(docs).first()
    kept = json.loads(row["payload"])
    assert (row["ac_total"], row["ac_kept"]) == (4, 1)
    assert kept["ac"] == [edge] and kept["msg"] == "No error" and kept["now"] == 1704067200000


@pytest.mark.parametrize("payload", ['{"now": 1}', '{"ac": {"q": 1}}', '{"ac": null}'])
def test_trim_leaves_payload_without_list(spark, payload):
    docs = keyed(spark).withColumn("payload", F.lit(payload))
    row = unify.bbox_trim(docs).first()
    assert row["payload"] == payload and row["ac_total"] is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-01T00:00:00Z", datetime(2024, 1, 1)),
        ("2024-01-01T00:00:00.250000+00:00", datetime(2024, 1, 1, 0, 0, 0, 250000)),
        ("2024-01-01T02:00:00+02:00", datetime(2024, 1, 1)),
        ("2024-01-01T00:00:00.123456", datetime(2024, 1, 1, 0, 0, 0, 123456)),
        ("soon", None),
    ],
)
def test_instants(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(instant("t").cast("timestamp_ntz").alias("t"))
    assert df.first()["t"] == expected


def calls(spark, *rows):
    return spark.createDataFrame(rows, "source string, fetched_at timestamp, payload string")


def winner(spark, *rows):
    return sorted(r["payload"] for r in unify.freshest_snapshot(calls(spark, *rows)).collect())


def test_freshest_source_wins_and_ties_go_to_the_positional_feed(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    p, k = K.POSITIONAL_SOURCE, K.KEYED_SOURCE
    assert winner(spark, (p, t1, "p1"), (k, t1, "k1")) == ["p1"]
    assert winner(spark, (p, t1, "p1"), (k, t2, "k2"), (k, t1, "k1")) == ["k2"]
    assert winner(spark, (k, t1, "k1")) == ["k1"]
    assert winner(spark, (p, None, "p0"), (k, t1, "k1"), (k, t1, "k1b")) == ["k1", "k1b"]


def test_unify_reads_each_feed_its_own_way(spark):
    docs = keyed(spark, BASE).unionByName(positional(spark, json.dumps({"states": [["p1", "X "] + [None] * 10]})))
    rows = {r["icao24"]: r for r in unify.unify_positions(docs).collect()}
    assert set(rows) == {"a1", "p1"}
    assert rows["a1"]["updated_at"] == T0 and rows["p1"]["created_at"] is not None


ODD_KEYED = [
    {"now": 1704067200000, "ac": [{**BASE, "baro_rate": None, "geom_rate": 3, "seen_pos": 1.5, "flight": " AB1 "}, {**BASE, "geom_rate": 3}]},
    {"now": 1704067200000.5, "ac": [{"hex": "b", "lat": "50.5", "lon": 8, "alt_baro": "ground", "nav": [1, "x"]}, {"hex": "c"}, {}]},
    {"ac": [{**BASE, "lat": 1e1, "lon": 9.0}, {**BASE, "lat": True}]},
    {"now": 5, "ac": {"hex": "a"}},
    {"now": 5, "ac": None},
    {"now": 5, "ac": [], "msg": {"deep": [1.5, None]}},
    {"msg": "none"},
]
ODD_TEXTS = ['{"now":1,"ac":[{"hex":"r","lat":50,"lat":51,"lon":9}]}', '{"now":1,"ac":[{"hex":"n","lat":50.5,"lon":9,"gs":NaN}],"a":1}', "[1]", "{}"]
ODD_STATES = [
    [["a ", " X ", None, 1, 1704067200, 9.5, 50.25, 1e3, True, None, 90, -1.5, None, None, "7000", False, 0], None, ["short"], []],
    [],
    None,
    {"no": "list"},
]


def odd_documents(spark):
    rows = [(json.dumps(p), K.KEYED_SOURCE, T0) for p in ODD_KEYED] + [(p, K.KEYED_SOURCE, T0) for p in ODD_TEXTS]
    rows += [(json.dumps({"states": s}), K.POSITIONAL_SOURCE, T0) for s in ODD_STATES] + [(None, K.KEYED_SOURCE, T0)]
    return spark.createDataFrame(rows, "payload string, source string, fetched_at timestamp")


def same_rows(one, other):
    assert one.columns == other.columns
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))


@pytest.mark.parametrize("stored", [False, True])
def test_fields_give_what_texts_give(spark, tmp_path, stored):
    """A repeated field and NaN have no variant and are read as text; null and missing stay apart."""
    docs = odd_documents(spark)
    parsed = unify.with_fields(docs)
    if stored:
        parsed.write.parquet(str(tmp_path / "docs"))
        parsed = spark.read.parquet(str(tmp_path / "docs"))
    assert parsed.where("NOT has_fields").count() == 3
    keyed_only = [d.where(F.col("source") == K.KEYED_SOURCE) for d in (docs, parsed)]
    same_rows(*[unify.unify_positions(d).drop("created_at") for d in (docs, parsed)])
    same_rows(*[unify.map_keyed(d, metric_rate=True, null_falls_back=True) for d in keyed_only])
    fields = [unify.keyed_aircraft(d).select("now", "a.hex", F.expr("try_cast(a.lon AS double)"), F.map_keys("a")) for d in keyed_only]
    same_rows(*[d.withColumn("keys", F.sort_array(d.columns[-1])).drop(d.columns[-1]) for d in fields])
    same_rows(*[unify.snapshot_faults(d) for d in (docs, parsed)])
    trimmed = [unify.bbox_trim(d) for d in keyed_only]
    assert trimmed[1].columns == [*parsed.columns, "ac_total", "ac_kept"]
    same_rows(*[d.select("ac_total", "ac_kept") for d in trimmed])
    same_rows(*[unify.map_keyed(d) for d in trimmed])
    texts = [[json.loads(r[0], parse_constant=str) if r[0] else None for r in d.select("payload").collect()] for d in trimmed]
    assert sorted(map(repr, map(flat, texts[0]))) == sorted(map(repr, map(flat, texts[1])))
    # Both columns were trimmed alike.
    same_rows(unify.map_keyed(trimmed[1]), unify.map_keyed(trimmed[1].drop("fields", "has_fields")))


def flat(value):
    return json.dumps(value, sort_keys=True) if not isinstance(value, float) else repr(value)


def test_documents_that_landed_without_fields_are_read_as_text(spark, tmp_path):
    path = str(tmp_path / "landing")
    for i, parse in enumerate((True, False)):
        raw = keyed(spark, {**BASE, "hex": f"h{i}"}).select("payload", "fetched_at")
        snapshots.land_snapshots(raw, path, K.KEYED_SOURCE, "run", parse=parse)
    docs = snapshots.read_snapshots(spark, path, parsed=True)
    assert sorted(map(tuple, docs.select("has_fields").collect()), key=str) == [(None,), (True,)]
    assert sorted(r["icao24"] for r in unify.unify_positions(docs).collect()) == ["h0", "h1"]
    assert snapshots.read_snapshots(spark, path).columns == snapshots.schemas.BRONZE.names
