"""The newest row per aircraft over a stream: late rows, nulls, repeats and expiry."""

import time
from datetime import datetime, timedelta

from skyframe.operators import live
from skyframe.session import new_folder
from skyframe.streaming import latest
from skyframe.streaming.latest import compact_latest, read_latest, stream_latest

SCHEMA = "id long, icao24 string, callsign string, time_position long, latitude float, on_ground boolean, updated_at timestamp"
AT = datetime(2024, 1, 30, 12, 0, 0, 123456)


def row(i, icao24="a", callsign="X", at=1):
    return (i, icao24, callsign, at, None if i % 5 == 0 else 47.1 + i / 7, i % 2 == 0, AT + timedelta(microseconds=i))


PARTS = [
    [row(1, at=50), row(2, at=None), row(3, "b", None, 10), row(4, None, None, 3), row(5, "c", "Y", 7)],
    # Late rows change nothing; ties go to the higher id; null keys and times count.
    [row(6, at=40), row(7, at=None), row(8, "b", None, 10), row(9, "b", None, 9), row(10, None, None, 4), row(0, "c", "Y", 7)],
    [row(11, "d", "", 1), row(12, "d", None, 1), row(8, "b", None, 10), *[row(100 + i, "hot", "H", i % 300) for i in range(2000)]],
]


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(path)


def cycle(spark, path, out, offsets, **more):
    rows = spark.readStream.schema(SCHEMA).parquet(path)
    stream_latest(rows, out, offsets, **more).awaitTermination()


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect())))


def test_follows_the_newest_row_of_everything_landed(spark):
    path, out, offsets = (new_folder(spark, n) for n in ("rows", "changes", "offsets"))
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read_latest(spark, out, schema).count() == 0
    landed = []
    for part in PARTS:
        land(spark, path, part)
        landed += part
        cycle(spark, path, out, offsets)
        assert bag(read_latest(spark, out, schema)) == bag(live.latest_per_aircraft(spark.createDataFrame(landed, SCHEMA)).dropDuplicates())
    # A cycle appends what changed: of the second part, two keys.
    cycles = {r["cycle"]: r["count"] for r in spark.read.parquet(out).groupBy("cycle").count().collect()}
    assert cycles == {0: 4, 1: 3, 2: 3}
    smaller = new_folder(spark, "compacted")
    compact_latest(spark, out, smaller)
    assert bag(read_latest(spark, smaller, schema)) == bag(read_latest(spark, out, schema))
    assert spark.read.parquet(smaller).count() == 7


def test_a_silent_key_expires_and_may_come_back(spark):
    path, out, offsets = (new_folder(spark, n) for n in ("rows", "changes", "offsets"))
    schema = spark.createDataFrame([], SCHEMA).schema
    keep = timedelta(seconds=1)
    land(spark, path, [row(1, "old", "A", 90)])
    cycle(spark, path, out, offsets, keep=keep)
    assert {r["icao24"] for r in read_latest(spark, out, schema).collect()} == {"old"}
    time.sleep(1.5)
    land(spark, path, [row(2, "new", "B", 10)])
    cycle(spark, path, out, offsets, keep=keep)
    assert {r["icao24"] for r in read_latest(spark, out, schema).collect()} == {"new"}
    land(spark, path, [row(3, "old", "A", 5)])
    cycle(spark, path, out, offsets, keep=timedelta(hours=1))
    assert [r["time_position"] for r in read_latest(spark, out, schema).where("icao24 = 'old'").collect()] == [5]


def test_keys_share_calls_and_expire_by_themselves(spark, monkeypatch):
    """State is kept by bucket, not by key: of keys in one bucket, only a silent one is forgotten."""
    monkeypatch.setattr(latest, "BUCKETS", 1)
    path, out, offsets = (new_folder(spark, n) for n in ("rows", "changes", "offsets"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def step(rows):
        land(spark, path, rows)
        stream = stream_latest(spark.readStream.schema(SCHEMA).parquet(path), out, offsets, keep=timedelta(seconds=3))
        stream.awaitTermination()
        assert stream.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
        return {(r["icao24"], r["callsign"]): r["id"] for r in read_latest(spark, out, schema).collect()}

    keys = [(f"k{i}", None if i % 2 else "") for i in range(40)]
    assert step([row(i, *k) for i, k in enumerate(keys)]) == {k: i for i, k in enumerate(keys)}
    time.sleep(4)
    # Two keys are heard of again before the others expire, one with an older row.
    want = {keys[3]: 103, keys[4]: 4, ("new", "X"): 7}
    assert step([row(103, *keys[3]), row(104, *keys[4], at=0), row(7, "new")]) == want
