"""Positions stored along a Z-order curve, and boxes and circles as ranges of it.

A cell number interleaves the bits of a row's grid column and row, so places near each other mostly
have numbers near each other. Rows are written in that order, by zone (the leading bits), and a
region is asked for as a few ranges of cells: zones prune folders before any file is opened, and
the ranges skip files and row groups by their least and greatest cell. Longitudes go round, so a
box across the date line is two runs of columns and needs no case of its own in the scan.

Ranges only narrow what is read. The region itself is always asked of the coordinates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.operators import star

#: Grid columns and rows are numbered with so many bits: 0.0055 degrees of longitude, half of it of latitude.
BITS = 16
SIDE = 1 << BITS
#: Leading bits of each axis that make a zone: 256 zones.
ZONE_BITS = 4
#: A cover stops dividing where it would pass so many ranges, whatever the region.
MOST_RANGES = 48


def _grid(degrees: float, span: float) -> int:
    return math.floor((degrees + span / 2) / span * SIDE)


def _spread(n: int) -> int:
    """The bits of ``n`` at every other place: its binary digits read to base 4."""
    return int(f"{n:b}", 4)


def cell_number(x: int, y: int) -> int:
    return _spread(y) * 2 + _spread(x)


def cell(lat: str, lon: str) -> Column:
    """The cell of a position; null where a coordinate is."""
    x = F.floor(F.pmod(F.col(lon).cast("double") + 180.0, F.lit(360.0)) / 360.0 * SIDE)
    y = F.floor((F.col(lat).cast("double") + 90.0) / 180.0 * SIDE)

    def spread(n):
        inside = F.greatest(F.least(n.cast("long"), F.lit(SIDE - 1)), F.lit(0))
        return F.conv(F.bin(inside), 4, 10).cast("long")

    number = spread(y) * 2 + spread(x)
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), number)


def with_cells(rows: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """``rows`` with ``cell`` and ``zone``, which replace columns of these names."""
    return rows.withColumn("cell", cell(lat, lon)).withColumn("zone", F.shiftright("cell", 2 * (BITS - ZONE_BITS)).cast("int"))


def write_cells(rows: DataFrame, path: str, lat: str = "latitude", lon: str = "longitude", mode: str = "append") -> None:
    """Write ``rows`` by zone and in the order of cells.

    Tasks take ranges of cells that Spark balances by rows. A digest of the row comes after the
    cell, so one place with a great share of the rows is parted as well.
    """
    celled = with_cells(rows, lat, lon)
    by = ["cell", F.xxhash64(*rows.columns)]
    celled.repartitionByRange(*by).sortWithinPartitions("zone", "cell").write.mode(mode).partitionBy("zone").parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def cover(boxes: list[tuple[int, int, int, int]], most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Ranges of cells, ends included, that hold every cell of the boxes of grid places (x0, x1, y0, y1).

    Squares are halved from the whole grid down, those outside dropped and those inside kept, for
    as long as their number stays in bounds. What is still open is taken whole.
    """
    whole, partial = [], [(0, 0, BITS)]
    while partial and len(whole) + 4 * len(partial) <= max(most, 4):
        parts = [(x + dx, y + dy, k - 1) for x, y, k in partial for dx in (0, 1 << k - 1) for dy in (0, 1 << k - 1)]
        partial = []
        for x, y, k in parts:
            far_x, far_y = x + (1 << k) - 1, y + (1 << k) - 1
            met = [b for b in boxes if b[0] <= far_x and x <= b[1] and b[2] <= far_y and y <= b[3]]
            if any(k == 0 or b[0] <= x and far_x <= b[1] and b[2] <= y and far_y <= b[3] for b in met):
                whole.append((x, y, k))
            elif met:
                partial.append((x, y, k))
    ranges: list[tuple[int, int]] = []
    for low, high in sorted((cell_number(x, y), cell_number(x, y) + (1 << 2 * k) - 1) for x, y, k in whole + partial):
        if ranges and ranges[-1][1] + 1 >= low:
            ranges[-1] = ranges[-1][0], max(high, ranges[-1][1])
        else:
            ranges.append((low, high))
    return ranges


def box_ranges(south: float, north: float, west: float, east: float, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """A cover of a box of degrees that runs eastward from ``west`` to ``east``, one grid place wider on each side.

    ``east`` below ``west`` is a box across the date line.
    """
    if east < west:
        east += 360.0
    y0, y1 = max(_grid(south, 180.0) - 1, 0), min(_grid(north, 180.0) + 1, SIDE - 1)
    x0, x1 = _grid(west, 360.0) - 1, _grid(east, 360.0) + 1
    if y0 > y1:
        return []
    if x1 - x0 + 1 >= SIDE:
        runs = [(0, SIDE - 1)]
    else:
        x0, x1 = x0 % SIDE, x1 % SIDE
        runs = [(x0, x1)] if x0 <= x1 else [(x0, SIDE - 1), (0, x1)]
    return cover([(a, b, y0, y1) for a, b in runs], most)


def in_ranges(ranges: list[tuple[int, int]]) -> Column:
    """Whether a stored row lies in a range; the zones of the ranges are named for the folders."""
    if not ranges:
        return F.lit(False)
    shift = 2 * (BITS - ZONE_BITS)
    zones = sorted({z for low, high in ranges for z in range(low >> shift, (high >> shift) + 1)})
    hit = F.lit(False)
    for low, high in ranges:
        hit |= F.col("cell").between(low, high)
    return F.col("zone").isin(zones) & hit


def in_box(
    stored: DataFrame, south: float, north: float, west: float, east: float, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Rows of a table of ``write_cells`` inside a box, rims included; ``east`` below ``west`` goes across the date line.

    Longitudes are compared as stored, between -180 and 180.
    """
    at = F.col(lon)
    across = at.between(west, east) if west <= east else (at >= west) | (at <= east)
    near = stored.where(in_ranges(box_ranges(south, north, west, east)))
    return near.where(F.col(lat).between(south, north) & across).drop("cell", "zone")


def within_radius(
    stored: DataFrame, lat0: float, lon0: float, radius_nm: float, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """``star.within_radius`` of a table of ``write_cells``, which reads the cells about the circle only.

    A circle that holds a pole takes every longitude down to its far side.
    """
    reach = radius_nm / star.NM_PER_DEGREE * 1.001
    south, north = max(lat0 - reach, -90.0), min(lat0 + reach, 90.0)
    west, east = -180.0, 180.0
    if north < 90.0 and south > -90.0:
        # The widest a circle gets, which is a little poleward of its centre.
        widest = math.sin(math.radians(min(reach, 90.0))) / math.cos(math.radians(lat0))
        if widest < 1.0:
            across = math.degrees(math.asin(widest)) * 1.001
            west, east = lon0 - across, lon0 + across
    near = stored.where(in_ranges(box_ranges(south, north, west, east)))
    return star.within_radius(near, lat0, lon0, radius_nm, lat, lon).drop("cell", "zone")
