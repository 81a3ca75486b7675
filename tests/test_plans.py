"""What the plans do with large and skewed data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skyframe import constants as K
from skyframe.operators import live, metrics, profile, star, unify
from skyframe.operators.encoding import TargetMeanEncoder
from skyframe.plans.position_queries import documents, landed
from skyframe.plans.standins import view
from skyframe.session import materialise
from skyframe.sources import snapshots
from skyframe.streaming.landing import trim_payload


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if run else text


@pytest.fixture
def conf(spark):
    before = {}

    def set_all(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["latest_per_aircraft", "live_kpis", "match_feeds", "dedup_overlaps", "build_fact_states"])
def test_newest_row_is_picked_before_the_shuffle(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert any(line.rstrip().endswith("Partial") for line in limits)
    assert any(line.rstrip().endswith("Final") for line in limits)


def test_filters_and_columns_reach_the_table_scan(spark, sf_dir):
    stored = materialise(view(spark, sf_dir, "positions"), "positions")
    text = plan(live.positioned(stored).select("icao24", "longitude"))
    assert "IsNotNull(longitude)" in text and "IsNotNull(latitude)" in text
    assert "ReadSchema: struct<icao24:string,longitude:double,latitude:double>" in text
    near = star.within_radius(stored, 49.5, 10.0, 150.0).select("id")._jdf.queryExecution().executedPlan().toString()
    condition = near.split("Filter")[1]
    assert "latitude#" in condition and "longitude#" in condition and "PushedFilters: [IsNotNull" in near


def test_landed_feeds_are_read_by_partition(spark, sf_dir):
    docs = snapshots.read_snapshots(spark, landed(spark, documents(spark, sf_dir)))
    text = plan(unify.unify_positions(docs))
    assert text.count("PartitionFilters: [isnotnull(source") == 2
    newest = plan(unify.newest_call(docs))
    assert "ReadSchema: struct<fetched_at:timestamp>" in newest
    freshest = unify.freshest_snapshot(docs)
    scans = [line for line in plan(freshest).splitlines() if "FileScan" in line and "payload" in line]
    assert len(scans) == 1 and "fetched_date#" in scans[0].split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert freshest.count() > 0


def test_scores_are_read_and_grouped_once(spark, sf_dir):
    scored = materialise(view(spark, sf_dir, "scored"), "scored")
    text = plan(metrics.classification_metrics(scored, score="p"), run=True)
    # Only the written ranges, one row per distinct score, are read again: for their sums and their totals.
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("ranges-" in line for line in scans)


def test_quantiles_read_the_columns_once(spark, sf_dir):
    flights = materialise(view(spark, sf_dir, "flights"), "flights")
    text = plan(profile.exact_quantiles(flights, ["Flight", "Time"]), run=True)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("ranges-" in line for line in scans)


def test_a_payload_is_trimmed_with_three_parses(spark, sf_dir, conf):
    conf(**{"spark.sql.debug.maxToStringFields": "1000", "spark.sql.maxPlanStringLength": "10000000"})
    docs = snapshots.read_snapshots(spark, landed(spark, documents(spark, sf_dir))).where(F.col("source") == "adsb_raw")
    trimmed = unify.bbox_trim(docs)
    assert plan(trimmed).count("from_json") == 3 and "get_json_object" not in plan(trimmed)
    # Mapping adds its own parse; nothing is repeated in a filter below the explode.
    assert plan(unify.map_keyed(trimmed.select(*docs.columns))).count("from_json") == 4


def test_counts_are_taken_before_dimensions_are_joined(spark, sf_dir):
    facts = materialise(view(spark, sf_dir, "positions"), "positions")
    aircraft, airlines = (view(spark, sf_dir, v) for v in ("dim_aircraft", "dim_airlines"))
    text = star.flights_per_airline_snowflake(facts, aircraft, airlines)._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    depth = {w: max(len(x) - len(x.lstrip(" :+-")) for x in lines if w in x) for w in ("Join", "Aggregate")}
    assert depth["Aggregate"] > depth["Join"]


def test_airlines_resolve_the_same_without_broadcast_and_with_a_hot_aircraft(spark, sf_dir, conf):
    facts = view(spark, sf_dir, "positions").select("id", "icao24", "callsign")
    hot = F.when(F.col("id") % 3 == 0, F.lit("000004")).otherwise(F.col("icao24"))
    facts = materialise(facts.withColumn("icao24", hot).repartition(8), "facts")
    dims = [materialise(view(spark, sf_dir, v), v) for v in ("dim_aircraft", "dim_airlines")]
    wanted = sorted(map(tuple, star.resolve_airline(facts, *dims).select("id", "airline_icao").collect()), key=str)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    resolved = star.resolve_airline(facts, *dims).select("id", "airline_icao")
    assert sorted(map(tuple, resolved.collect()), key=str) == wanted
    text = plan(resolved, run=True)
    assert "BroadcastHashJoin" not in text and "skew=true" in text


def test_target_means_are_the_same_without_broadcast(spark, sf_dir, conf):
    flights = materialise(view(spark, sf_dir, "flights"), "flights")
    encoder = TargetMeanEncoder(inputCols=K.HIGH_CARD_FEATURES, outputCols=["f", "t"], foldKey=["Flight"])

    def rows():
        model, out = encoder.fitTransform(flights)
        return [sorted((r["Flight"], round(r["f"], 9), round(r["t"], 9)) for r in d.collect()) for d in (out, model.transform(flights))]

    wanted = rows()
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert rows() == wanted


def test_stored_fields_are_read_by_path_and_trimming_parses_once(spark, sf_dir):
    docs = documents(spark, sf_dir).where(F.col("source") == K.KEYED_SOURCE).select("payload", "fetched_at")
    prepared = plan(snapshots.prepare(docs, K.KEYED_SOURCE, "run", trim_payload, parse=True))
    assert prepared.count("tryparsejson") + prepared.count("try_parse_json(") + prepared.count("parseJson(") == 1
    stored = snapshots.read_snapshots(spark, landed(spark, documents(spark, sf_dir), parse=True), K.KEYED_SOURCE, parsed=True)
    rows = unify.keyed_aircraft(stored.where("has_fields")).select("a.hex", "now")
    text = plan(rows)
    by_path, by_text = text.split("Union")[1].split("FileScan")[1:3]
    schema = by_path.split("ReadSchema: ")[1].splitlines()[0]
    assert "payload" not in schema and "EqualTo(has_fields,true)" in by_path and "Not(EqualTo(has_fields,true))" in by_text
    assert text.split("Union")[1].split("FileScan")[0].count("from_json") == 0
