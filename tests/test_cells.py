"""Positions in the order of a curve: covers, pruning and unchanged answers."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyframe.operators import cells, star
from skyframe.session import new_folder


@pytest.fixture(scope="module")
def places(spark):
    rng = random.Random(11)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(6000)]
    rows += [(10_000 + i, rng.gauss(50, 1), rng.gauss(10, 1)) for i in range(3000)]
    rows += [(20_000 + i, rng.uniform(-3, 3), (180 + rng.uniform(-3, 3) + 180) % 360 - 180) for i in range(1000)]
    rows += [(30_000, 90.0, 0.0), (30_001, -90.0, 180.0), (30_002, 0.0, 180.0), (30_003, 0.0, -180.0), (30_004, 0.0, 0.0)]
    rows += [(40_000, None, 1.0), (40_001, 1.0, None), (40_002, float("nan"), 1.0), (40_003, 1.0, float("nan"))]
    return spark.createDataFrame(rows, "id long, latitude double, longitude double").cache()


@pytest.fixture(scope="module")
def stored(spark, places):
    path = new_folder(spark, "cells")
    cells.write_cells(places.repartition(8), path)
    return cells.read_cells(spark, path)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def files_read(df):
    """Files that the scan opened, from the plan's own count."""
    df._jdf.queryExecution().toRdd().count()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().get("numFiles").get().value()


def test_nothing_is_lost_by_writing(places, stored):
    assert ids(stored) == ids(places)


def test_cells_agree_with_the_covers_grid(places):
    rows = cells.with_cells(places.where("id < 30000")).collect()
    for r in random.Random(1).sample(rows, 500):
        x, y = (min(cells._grid(v, s), cells.SIDE - 1) for v, s in ((r["longitude"], 360.0), (r["latitude"], 180.0)))
        assert r["cell"] == cells.cell_number(x, y)
    assert cells.with_cells(places).where("id IN (40000, 40001) AND cell IS NULL").count() == 2


CIRCLES = [(49.5, 10.0, 150.0), (0.0, 179.9, 200.0), (1.0, -179.5, 90.0), (89.5, 20.0, 300.0), (-89.9, 0.0, 60.0), (78.0, 175.0, 800.0), (0.0, 0.0, 0.0), (10.0, 10.0, 6000.0)]


@pytest.mark.parametrize("circle", CIRCLES)
def test_circles_are_the_same_as_without_cells(places, stored, circle):
    plain, near = star.within_radius(places, *circle), cells.within_radius(stored, *circle)
    assert sorted(near.columns) == sorted(plain.columns)
    by_hand = places.where(~F.isnan("latitude") & ~F.isnan("longitude")).where(star.distance_nm("latitude", "longitude", *circle[:2]) <= circle[2])
    assert ids(near) == ids(by_hand)
    assert ids(near) == ids(plain)


@pytest.mark.parametrize("box", [(47.0, 55.0, 5.0, 15.0), (-2.0, 2.0, 178.0, -178.0), (-90.0, 90.0, -180.0, 180.0), (0.0, 0.0, 0.0, 0.0), (60.0, 50.0, 0.0, 1.0), (-90.0, -89.0, -180.0, 180.0)])
def test_boxes(places, stored, box):
    south, north, west, east = box
    across = f"longitude BETWEEN {west} AND {east}" if west <= east else f"(longitude >= {west} OR longitude <= {east})"
    assert ids(cells.in_box(stored, *box)) == ids(places.where(f"latitude BETWEEN {south} AND {north} AND {across}"))


def test_a_circle_opens_few_files(stored):
    every = files_read(stored.select("id"))
    for lat, lon in ((49.5, 10.0), (0.0, 179.9)):
        near = cells.within_radius(stored, lat, lon, 150.0).select("id")
        assert files_read(near) <= every / 10
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [zone" in text and "GreaterThanOrEqual(cell" in text


def test_a_crowded_place_is_parted(spark):
    crowd = spark.range(20_000).select("id", F.lit(50.0).alias("latitude"), F.lit(10.0).alias("longitude"))
    path = new_folder(spark, "crowd")
    cells.write_cells(crowd.withColumn("more", F.sha2(F.col("id").cast("string"), 512)), path)
    sizes = [r["count"] for r in cells.read_cells(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20_000
    text = cells.with_cells(crowd).repartitionByRange(4, "cell", F.xxhash64(*crowd.columns)).rdd.glom().map(len).collect()
    assert max(text) < 10_000


def test_an_empty_table(spark):
    path = new_folder(spark, "empty")
    empty = spark.createDataFrame([], "id long, latitude double, longitude double, zone int, cell long")
    assert cells.with_cells(empty).count() == 0
    assert cells.within_radius(cells.with_cells(empty), 0.0, 0.0, 10.0).count() == 0
    assert path


@settings(max_examples=60, deadline=None)
@given(st.floats(-90, 90), st.floats(0, 60), st.floats(-180, 180), st.floats(0, 359), st.floats(0, 1), st.floats(0, 1))
def test_covers_hold_every_place_of_a_box(south, height, west, width, up, along):
    north, east = min(south + height, 90.0), west + width
    lat, lon = south + (north - south) * up, west + (east - west) * along
    lon = (lon + 180.0) % 360.0 - 180.0
    east = (east + 180.0) % 360.0 - 180.0 if east > 180.0 else east
    x, y = cells._grid(lon, 360.0) % cells.SIDE, min(cells._grid(lat, 180.0), cells.SIDE - 1)
    number = cells.cell_number(x, y)
    ranges = cells.box_ranges(south, north, west, east)
    assert any(low <= number <= high for low, high in ranges)
    assert len(ranges) <= cells.MOST_RANGES
    assert all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
