"""Landing, retention, refresh and the streams."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.operators.unify import map_keyed
from skyframe.session import new_folder, shared_dir
from skyframe.sources import positions, snapshots
from skyframe.streaming.landing import stream_land, trim_payload
from skyframe.streaming.refresh import stream_refresh

T1, T2, T3 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10), datetime(2024, 1, 3, 10)
AIRCRAFT = {"hex": "a1", "lat": 48.5, "lon": 9.25, "seen_pos": 1}
VECTOR = ["p1", "DLH1", "DE", 1704067200, 0, 8.5, 50.5, 0, False, 0, 90.0, 2.0]


def ac(*aircraft):
    return json.dumps({"now": 1704067200000, "ac": list(aircraft)})


def states(*vectors):
    return json.dumps({"states": list(vectors)})


def raw(spark, *rows):
    return spark.createDataFrame(rows, "payload string, fetched_at timestamp")


def land(spark, path, source, *rows, **options):
    return snapshots.land_snapshots(raw(spark, *rows), path, source, "run_1", **options)


@pytest.mark.parametrize(
    "payload, reason",
    [
        ("{bad", "invalid_json"),
        ("", "invalid_json"),
        (None, "invalid_json"),
        ("null", "empty"),
        (" [ ] ", "empty"),
        ("{\n}", "empty"),
        ("5", "unexpected_type"),
        ('"text"', "unexpected_type"),
        ("true", "unexpected_type"),
        ('{"a": null}', None),
        ("[{}]", None),
    ],
)
def test_guard(spark, payload, reason):
    assert snapshots.parse_guard(raw(spark, (payload, T1))).first()["reason"] == reason


def test_landing_stamps_and_splits_lists(spark):
    path = new_folder(spark, "t")
    rows = land(spark, path, "opaque", ('[{"a": 1}, {"b": "x"}]', T1), ("{bad", T1), ("{}", T1)).collect()
    assert sorted(r["payload"] for r in rows) == ['{"a":1}', '{"b":"x"}']
    assert {(r["source"], r["fetched_at"], r["pipeline_run_id"]) for r in rows} == {("opaque", T1, "run_1")}
    assert all(r["load_date"] is not None and str(r["fetched_date"]) == "2024-01-01" for r in rows)


def test_landing_stamps_now_without_a_call_time(spark):
    one = spark.createDataFrame([('{"a": 1}',)], "payload string")
    row = snapshots.land_snapshots(one, new_folder(spark, "t"), "s", "r").first()
    assert abs((row["fetched_at"] - datetime.now(timezone.utc).replace(tzinfo=None)).total_seconds()) < 600


def test_landing_accepts_text_call_times(spark):
    one = spark.createDataFrame([('{"a": 1}', "2024-01-01T12:00:00+02:00")], "payload string, fetched_at string")
    assert snapshots.land_snapshots(one, new_folder(spark, "t"), "s", "r").first()["fetched_at"] == T1


def test_duplicate_keys_are_skipped_and_the_rest_written(spark):
    path = new_folder(spark, "t")
    land(spark, path, "s", ('{"a": 1}', T1), key=("payload",))
    land(spark, path, "other", ('{"a": 2}', T1), key=("payload",))
    rows = land(spark, path, "s", ('{"a": 1}', T2), ('{"a": 2}', T2), ('{"a": 2}', T2), key=("payload",)).collect()
    assert sorted((r["payload"], r["fetched_at"]) for r in rows) == [('{"a": 1}', T1), ('{"a": 2}', T2)]


def test_transform_runs_before_storing(spark):
    path = new_folder(spark, "t")
    far = {"hex": "far", "lat": 10, "lon": 10}
    rows = land(spark, path, K.KEYED_SOURCE, (ac(AIRCRAFT, far), T1), transform=trim_payload)
    assert [r["icao24"] for r in map_keyed(rows).collect()] == ["a1"]
    assert json.loads(rows.first()["payload"])["ac"] == [AIRCRAFT]


def test_newest_first(spark):
    path = new_folder(spark, "t")
    land(spark, path, "s", ('{"a":1}', T1), ('{"a":3}', T3), ('{"a":2}', T2), rebalance=True)
    rows = snapshots.read_snapshots(spark, path, "s", newest_first=True).collect()
    assert [r["payload"] for r in rows] == ['{"a":3}', '{"a":2}', '{"a":1}']


def test_retention(spark):
    path = new_folder(spark, "t")
    land(spark, path, "s", ("[1]", T1), ("[2]", T2), ("[3]", T3))
    undated = spark.createDataFrame([("[0]", "not a date")], "payload string, fetched_at string")
    snapshots.land_snapshots(undated, path, "s", "r")
    now = datetime(2024, 1, 3, 11, tzinfo=timezone.utc)
    live = snapshots.unexpired(snapshots.read_snapshots(spark, path), F.lit(now))
    assert sorted(r["payload"] for r in live.collect()) == ["0", "3"]
    dropped = snapshots.drop_expired(spark, path, now)
    assert len(dropped) == 1 and "2024-01-01" in dropped[0]
    left = snapshots.read_snapshots(spark, path).collect()
    assert sorted(r["payload"] for r in left) == ["0", "2", "3"]


def table_rows(spark, name="map1"):
    return sorted(r["icao24"] for r in positions.read_positions(spark, name).collect())


def test_refresh_replaces_the_table_or_leaves_it(spark):
    path = new_folder(spark, "t")
    with pytest.raises(positions.RefreshRefused):
        positions.refresh_positions(raw(spark).withColumn("source", F.lit("s")).limit(0), "map1")
    land(spark, path, K.POSITIONAL_SOURCE, (states(VECTOR), T1))
    docs = snapshots.read_snapshots(spark, path)
    positions.refresh_positions(docs, "map1")
    assert table_rows(spark) == ["p1"]
    reader = positions.read_positions(spark)

    land(spark, path, K.KEYED_SOURCE, (ac(AIRCRAFT), T2))
    docs = snapshots.read_snapshots(spark, path)
    positions.refresh_positions(docs, "map1")
    assert table_rows(spark) == ["a1"]
    assert [r["icao24"] for r in reader.collect()] == ["p1"]

    land(spark, path, K.POSITIONAL_SOURCE, ('{"states": null}', T3))
    with pytest.raises(positions.RefreshRefused):
        positions.refresh_positions(snapshots.read_snapshots(spark, path), "map1")
    assert table_rows(spark) == ["a1"]


def test_refresh_refuses_repeated_keys_but_not_null_ones(spark):
    good, path = new_folder(spark, "t"), new_folder(spark, "t")
    unknown = [*VECTOR[:3], None, *VECTOR[4:]]
    land(spark, good, K.POSITIONAL_SOURCE, (states(unknown, unknown), T1))
    positions.refresh_positions(snapshots.read_snapshots(spark, good), "q_map1")
    land(spark, path, K.POSITIONAL_SOURCE, (states(VECTOR, VECTOR), T1))
    with pytest.raises(positions.RefreshRefused):
        positions.refresh_positions(snapshots.read_snapshots(spark, path), "q_map1")
    assert table_rows(spark, "q_map1") == ["p1", "p1"]
    ids = [r["id"] for r in positions.read_positions(spark, "q_map1").collect()]
    assert len(set(ids)) == 2


def test_old_versions_are_dropped(spark):
    path, root = new_folder(spark, "t"), new_folder(spark, "versions")
    land(spark, path, K.POSITIONAL_SOURCE, (states(VECTOR), T1))
    docs = snapshots.read_snapshots(spark, path)
    made = [positions.refresh_positions(docs, "q_map1", root) for _ in range(3)]
    dropped = positions.drop_old_versions(spark, "q_map1", root, keep=2)
    assert [d.rsplit("/", 1)[1] for d in dropped] == [made[0].rsplit("/", 1)[1]]
    assert table_rows(spark, "q_map1") == ["p1"]


def test_an_empty_list_empties_the_table(spark):
    path = new_folder(spark, "t")
    land(spark, path, K.POSITIONAL_SOURCE, (states(), T1))
    positions.refresh_positions(snapshots.read_snapshots(spark, path), "map1")
    assert table_rows(spark) == []


def test_tables_are_allow_listed(spark):
    with pytest.raises(ValueError):
        positions.read_positions(spark, "map1; drop table x")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def run(query):
    query.awaitTermination()
    return query


ONCE = {"availableNow": True}


def write_file(folder, name, text):
    import pathlib

    target = pathlib.Path(folder.removeprefix("file:"))
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(text)


def test_stream_land_picks_up_new_files_only(spark):
    drop, path, offsets = (new_folder(spark, n) for n in ("drop", "land", "offsets"))
    far = {"hex": "far", "lat": 10, "lon": 10}
    write_file(drop, "1.json", json.dumps(json.loads(ac(AIRCRAFT, far)), indent=2))
    write_file(drop, "2.json", "{bad")
    start = lambda: run(
        stream_land(spark, drop, path, K.KEYED_SOURCE, "r", offsets, ONCE, whole_files=True)
    )
    start()
    write_file(drop, "3.json", ac({**AIRCRAFT, "hex": "b2"}))
    start()
    start()
    rows = map_keyed(snapshots.read_snapshots(spark, path, K.KEYED_SOURCE)).collect()
    assert sorted(r["icao24"] for r in rows) == ["a1", "b2"]


def test_stream_refresh_follows_the_freshest_call(spark):
    path, offsets = new_folder(spark, "land"), new_folder(spark, "offsets")
    cycle = lambda: run(stream_refresh(spark, {"all": path}, "map1", offsets, trigger=ONCE))
    land(spark, path, K.POSITIONAL_SOURCE, (states(VECTOR), T2))
    land(spark, path, K.KEYED_SOURCE, (ac(AIRCRAFT), T2))
    cycle()
    assert table_rows(spark) == ["p1"]  # tie
    land(spark, path, K.KEYED_SOURCE, (ac({**AIRCRAFT, "hex": "new"}), T3))
    cycle()
    assert table_rows(spark) == ["new"]
    land(spark, path, K.POSITIONAL_SOURCE, (states(["late", *VECTOR[1:]]), T1))
    cycle()
    assert table_rows(spark) == ["new"]  # late and older
    land(spark, path, K.KEYED_SOURCE, (ac(AIRCRAFT, AIRCRAFT), datetime(2024, 1, 4)))
    cycle()
    assert table_rows(spark) == ["new"]  # refused: repeated key


@pytest.mark.parametrize(
    "payload, reason",
    [
        ('{"a":1,"a":2}', None),
        ('{"ac":[{"hex":"x","hex":"y"}]}', None),
        ('{"a":NaN}', None),
        ("[1] x", "invalid_json"),
        ('{"a":1} {"b":2}', "invalid_json"),
        ('{"a":1},"w":2', "invalid_json"),
        ('{"a":1}],"w":[2', "invalid_json"),
        ('1,"z":0}', "invalid_json"),
        ("   ", "invalid_json"),
    ],
)
def test_guard_on_whole_values(spark, payload, reason):
    assert snapshots.parse_guard(raw(spark, (payload, T1))).first()["reason"] == reason


def test_guard_has_no_size_limit(spark):
    big = spark.range(1).select(F.concat(F.lit('{"ac":['), F.array_join(F.array_repeat(F.lit('{"hex":"abcdef"}'), 2_000_000), ","), F.lit("]}")).alias("payload"))
    assert snapshots.parse_guard(big).select("reason", F.length("payload").alias("n")).first() == (None, 34_000_008)


def test_streams_batches_and_retention_share_a_folder(spark):
    path = new_folder(spark, "land")
    for source, text in ((K.POSITIONAL_SOURCE, states(VECTOR)), (K.KEYED_SOURCE, ac(AIRCRAFT))):
        drop, offsets = new_folder(spark, "drop"), new_folder(spark, "offsets")
        write_file(drop, "1.json", text)
        run(stream_land(spark, drop, path, source, "r", offsets, ONCE))
    land(spark, path, K.KEYED_SOURCE, (ac(AIRCRAFT), T1), (ac(AIRCRAFT), T2))
    count = lambda: {r["source"]: r["count"] for r in snapshots.read_snapshots(spark, path).groupBy("source").count().collect()}
    assert count() == {K.POSITIONAL_SOURCE: 1, K.KEYED_SOURCE: 3}
    assert len(snapshots.drop_expired(spark, path)) == 2
    assert count() == {K.POSITIONAL_SOURCE: 1, K.KEYED_SOURCE: 1}


def test_a_batch_written_again_replaces_itself(spark):
    path = new_folder(spark, "land")
    docs = snapshots.prepare(raw(spark, ('{"a":1}', T1), ('{"a":2}', T2)), "s", "r")
    for _ in range(2):
        snapshots.append_batch(docs, path, "one")
    snapshots.append_batch(docs.limit(1), path, "two")
    assert snapshots.read_snapshots(spark, path).count() == 3


def test_retention_at_read_time(spark):
    path = new_folder(spark, "t")
    land(spark, path, "s", ("[1]", T1), ("[2]", T2), ("[3]", T3))
    now = F.lit("2024-01-03 09:59:59").cast("timestamp")
    assert sorted(r["payload"] for r in snapshots.read_snapshots(spark, path, now=now, hours=24).collect()) == ["2", "3"]
    later = F.lit("2024-01-03 10:00:01").cast("timestamp")
    assert sorted(r["payload"] for r in snapshots.read_snapshots(spark, path, now=later, hours=24).collect()) == ["3"]


def test_the_live_version_stays(spark):
    path, root = new_folder(spark, "t"), new_folder(spark, "versions")
    land(spark, path, K.POSITIONAL_SOURCE, (states(VECTOR), T1))
    docs = snapshots.read_snapshots(spark, path)
    positions.refresh_positions(docs, "q_map1", root)
    spark.range(1).write.parquet(new_folder(spark, "q_map1", root))  # still being written
    assert positions.drop_old_versions(spark, "q_map1", root, keep=1) == []
    assert table_rows(spark, "q_map1") == ["p1"]


def test_refresh_tries_again_without_new_files(spark, monkeypatch):
    import time

    from skyframe.streaming import refresh as module

    tried = []

    def failing(docs, table, root):
        tried.append(docs.count())
        if len(tried) < 3:
            raise OSError("storage is away")

    monkeypatch.setattr(module, "refresh_positions", failing)
    path = new_folder(spark, "land")
    land(spark, path, K.POSITIONAL_SOURCE, (states(VECTOR), T2))
    query = stream_refresh(spark, {"all": path}, "map1", new_folder(spark, "offsets"), trigger={"processingTime": "1 second"})
    until = time.time() + 90
    while len(tried) < 3 and time.time() < until:
        time.sleep(0.5)
    time.sleep(3)
    assert query.isActive
    query.stop()
    assert tried == [1, 1, 1]


def test_null_keys_land_once(spark):
    path = new_folder(spark, "landing")
    raw = spark.createDataFrame([('{"a": 1}', None), ('{"a": 2}', T1)], "payload string, fetched_at timestamp")
    for _ in range(3):
        snapshots.land_snapshots(raw, path, "s", "run", key=("payload", "fetched_at"))
    assert snapshots.read_snapshots(spark, path).count() == 2


def test_a_landing_reads_digests_of_its_own_days_only(spark):
    path = new_folder(spark, "landing")
    raw = spark.range(40).select(
        F.concat(F.lit('{"a": '), F.col("id").cast("string"), F.lit("}")).alias("payload"),
        (F.lit(T1).cast("timestamp") + F.make_dt_interval(days=(F.col("id") % 20).cast("int"))).alias("fetched_at"),
    )
    snapshots.land_snapshots(raw, path, "s", "run", key=("payload", "fetched_at"))
    today = raw.where("id % 20 = 3") if "id" in raw.columns else raw.where(F.col("payload").rlike("[: ](3|23)}"))
    days = snapshots.days_of(today)
    assert len(days) == 1
    stored = snapshots.stored_keys(spark, path, "s", [snapshots.DIGEST, "fetched_at"], days)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "fetched_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "payload:" not in scan.split("ReadSchema: ")[1]
    read = {f.split("fetched_date=")[1].split("/")[0] for f in stored.inputFiles()}
    assert str(days[0]) in read
    assert stored.count() == 2
    snapshots.land_snapshots(today, path, "s", "run", key=("payload", "fetched_at"))
    assert snapshots.read_snapshots(spark, path).count() == 40


def test_history_grows_by_new_files_only(spark, sf_dir, monkeypatch):
    """A second run reads what landed since; overlapping calls settle as in one build."""
    from skyframe.operators import star
    from skyframe.plans.star_queries import dims, documents
    from skyframe.streaming import facts as history
    from skyframe.streaming.facts import read_fact_states, stream_fact_states

    append, batches = history.append_observations, []

    def recorded(batch, path, name):
        batches.append(batch.count())
        append(batch, path, name)

    monkeypatch.setattr(history, "append_observations", recorded)
    landing, facts, checkpoint = (new_folder(spark, x) for x in ("landing", "facts", "facts-checkpoint"))
    docs = documents(spark, sf_dir).where("source IS NOT NULL").limit(60).cache()
    read = []
    for part in (F.col("fetched_at") <= F.lit("2024-01-08"), F.lit(True)):
        for source in ("states_all", "adsb_raw"):
            mine = docs.where((F.col("source") == source) & part).select("payload", "fetched_at")
            snapshots.land_snapshots(mine, landing, source, "run", key=("payload", "fetched_at"))
        stream_fact_states(spark, landing, facts, checkpoint).awaitTermination()
        read.append(sum(batches))
    landed = snapshots.read_snapshots(spark, landing)
    assert 0 < read[0] < read[1] == landed.count()
    aircraft, airlines = dims(spark, sf_dir)
    got, want = read_fact_states(spark, facts, aircraft, airlines), star.build_fact_states(landed, aircraft, airlines)
    key = sorted(want.columns)
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, want.select(key).collect())) and want.count() > 0
