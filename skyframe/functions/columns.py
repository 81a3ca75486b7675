"""Text, time, geography and marker expressions. All stay inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyframe import constants as K

# The characters a text strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

EARTH_RADIUS_NM = 3440.065


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stripped(c: Column | str) -> Column:
    """Both ends trimmed of every whitespace character, tabs and no-break spaces included."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean_callsign(c: Column | str) -> Column:
    """Trimmed callsign, null when nothing is left."""
    return F.nullif(stripped(c), F.lit(""))


def clean_code(c: Column | str) -> Column:
    return F.upper(stripped(c))


def callsign_prefix(c: Column | str) -> Column:
    """ICAO airline part of a callsign: the first three characters once trimmed."""
    return F.nullif(F.substring(stripped(c), 1, 3), F.lit(""))


def instant(c: Column | str, dtype: str = "string") -> Column:
    """A date or ISO text (``Z``, an offset, or naive meaning UTC) as an instant; bad text is null."""
    c = _col(c)
    return F.try_to_timestamp(c) if dtype == "string" else c.cast("timestamp")


def in_box(
    lat: Column | str,
    lon: Column | str,
    south: float = K.SOUTH,
    north: float = K.NORTH,
    west: float = K.WEST,
    east: float = K.EAST,
) -> Column:
    """Inside the box, edges included. A missing coordinate gives null, which filters drop."""
    return _col(lat).between(south, north) & _col(lon).between(west, east)


def distance_nm(lat: Column | str, lon: Column | str, lat0: float, lon0: float) -> Column:
    """Great-circle distance to a point in nautical miles (haversine)."""
    lat, lon = _col(lat).cast("double"), _col(lon).cast("double")
    dlat, dlon = F.radians(lat - lat0) / 2, F.radians(lon - lon0) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(F.lit(lat0))) * F.cos(F.radians(lat)) * F.pow(F.sin(dlon), 2)
    return 2 * EARTH_RADIUS_NM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _level(rate: Column) -> Column:
    return rate.isNull() | (F.abs(rate) < K.LEVEL_BELOW)


def flight_phase(rate: Column | str) -> Column:
    rate = _col(rate)
    return F.when(_level(rate), "Level").when(rate > 0, "Climbing").otherwise("Descending")


def phase_arrow(rate: Column | str) -> Column:
    rate = _col(rate)
    return F.when(_level(rate), "").when(rate > 0, K.CLIMB_ARROW).otherwise(K.DESCEND_ARROW)


def aircraft_label(callsign: Column | str, icao24: Column | str) -> Column:
    """Callsign, else aircraft address, else "Unknown"; empty text counts as missing."""
    empty = F.lit("")
    return F.coalesce(F.nullif(_col(callsign), empty), F.nullif(_col(icao24), empty), F.lit("Unknown"))


def day_bucket(minutes: Column | str) -> Column:
    """Part of the day; upper edges belong to their bucket, out of range is null."""
    minutes = _col(minutes)
    lowest = -0.1
    bucket = F.when(minutes <= lowest, F.lit(None).cast("string"))
    for name, upper in K.DAY_BUCKETS:
        bucket = bucket.when(minutes <= upper, name)
    return bucket


def is_weekend(day: Column | str) -> Column:
    return F.coalesce(_col(day).isin(*K.WEEKEND_DAYS).cast("int"), F.lit(0))


def class_label(c: Column | str) -> Column:
    c = _col(c)
    label = F.when(c == 0, K.CLASS_LABELS[0])
    return label.when(c == 1, K.CLASS_LABELS[1])
