"""From raw snapshot documents of either feed to one row shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.columns import clean_callsign, in_box
from skyframe.schemas import POSITION_COLUMNS

FT_PER_MIN_IN_M_PER_S = 0.00508
#: The payload as a variant, and whether it could be one.
FIELDS, HAS_FIELDS = "fields", "has_fields"


def with_fields(docs: DataFrame) -> DataFrame:
    """Parse each payload once; later queries read its fields by path.

    Adds ``fields``, a variant, and ``has_fields``. A text that a variant can't hold (a repeated
    field, NaN, more than a variant's size) has none, and is read as text by every operator.
    """
    return docs.withColumn(FIELDS, F.try_parse_json("payload")).withColumn(HAS_FIELDS, F.col(FIELDS).isNotNull())


def _branches(docs: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Documents that are read by path, if any can be, and those that are read as text."""
    if HAS_FIELDS not in docs.columns:
        return None, docs
    # Both tests reach the scan of landed documents, so a file that is parsed throughout is not read as text.
    return docs.where(F.col(HAS_FIELDS)), docs.where(~F.col(HAS_FIELDS) | F.col(HAS_FIELDS).isNull())


def _in_box(lat: Column, lon: Column) -> Column:
    return in_box(lat.try_cast("double"), lon.try_cast("double"))


def bbox_trim(docs: DataFrame) -> DataFrame:
    """Drop aircraft outside the box from keyed payloads; adds ``ac_total`` and ``ac_kept``.

    Aircraft are kept or dropped as raw JSON text, so every field of a kept one
    survives. A payload whose ``ac`` is not a list is left as it is and both counts are null.
    The list is parsed for its texts and for its positions, and the other fields once. Documents
    with ``fields`` (see ``with_fields``) are not parsed again: both columns are trimmed alike,
    and the payload is written anew from the fields, so its numbers may be spelled otherwise.
    """
    if FIELDS in docs.columns:
        return _trim_fields(docs)
    at = F.from_json("payload", "ac array<struct<lat: string, lon: string>>")["ac"]

    def inside(pair: Column) -> Column:
        return _in_box(pair["at"]["lat"], pair["at"]["lon"])

    pairs = F.filter(F.arrays_zip(F.col("_ac").alias("text"), at.alias("at")), inside)
    # The other top-level fields keep their JSON types as variants.
    rest = F.to_json(F.map_filter(F.from_json("payload", "map<string,variant>"), lambda k, _: k != "ac"))
    trimmed = F.concat(F.regexp_replace(rest, r"\}$", ","), F.lit('"ac":['), F.concat_ws(",", "_kept"), F.lit("]}"))
    listed = F.col("_ac").isNotNull()
    return (
        docs.withColumn("_ac", F.from_json("payload", "ac array<string>")["ac"])
        .withColumn("_kept", F.transform(pairs, lambda pair: pair["text"]))
        .withColumn("ac_total", F.when(listed, F.size("_ac")))
        .withColumn("ac_kept", F.when(listed, F.size("_kept")))
        .withColumn("payload", F.when(listed, F.regexp_replace(trimmed, r"^\{,", "{")).otherwise(F.col("payload")))
        .drop("_ac", "_kept")
    )


def _trim_fields(docs: DataFrame) -> DataFrame:
    # What has no fields goes the way of texts; for all others that payload is null and nothing is parsed.
    rows = bbox_trim(
        docs.withColumn("_fields", F.col(FIELDS))
        .withColumn("_payload", F.col("payload"))
        .withColumn("payload", F.when(F.col(FIELDS).isNull(), F.col("payload")))
        .drop(FIELDS)
    )

    def inside(item: Column) -> Column:
        return _in_box(F.try_variant_get(item, "$.lat", "string"), F.try_variant_get(item, "$.lon", "string"))

    top = F.map_filter(F.try_variant_get("_fields", "$", "map<string,variant>"), lambda k, _: k != "ac")
    trimmed = F.to_variant_object(F.map_concat(top, F.create_map(F.lit("ac"), F.to_variant_object("_kept"))))
    listed = F.col("_listed").isNotNull()
    rows = (
        rows.withColumn("_listed", F.try_variant_get("_fields", "$.ac", "array<variant>"))
        .withColumn("_kept", F.filter("_listed", inside))
        .withColumn(FIELDS, F.when(listed, trimmed).otherwise(F.col("_fields")))
        .withColumn("ac_total", F.when(listed, F.size("_listed")).otherwise(F.col("ac_total")))
        .withColumn("ac_kept", F.when(listed, F.size("_kept")).otherwise(F.col("ac_kept")))
        .withColumn(
            "payload",
            F.when(listed, F.to_json(FIELDS)).when(F.col("_fields").isNotNull(), F.col("_payload")).otherwise(F.col("payload")),
        )
    )
    return rows.select(*docs.columns, "ac_total", "ac_kept")


def _number(value: Column, dtype: str) -> Column:
    return value.try_cast("double").try_cast(dtype)


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("payload", FIELDS, HAS_FIELDS)]


def _with_states(docs: DataFrame) -> DataFrame:
    """The carried columns and ``states``, null where the payload lists none."""
    parsed, text = _branches(docs)
    rows = text.select(*_carried(docs), F.from_json("payload", "states array<array<string>>")["states"].alias("states"))
    if parsed is None:
        return rows
    return parsed.select(*_carried(docs), F.try_variant_get(FIELDS, "$.states", "array<array<string>>").alias("states")).unionByName(rows)


def map_positional(docs: DataFrame) -> DataFrame:
    """Rows of the positional feed: picked by index, nothing filtered or trimmed."""
    v = {name: F.get("v", F.lit(i)) for name, i in K.VECTOR_INDEX.items()}
    # A list item is wrapped, as a null one is a row too. A plain explode would parse twice (see keyed_aircraft).
    items = F.transform("states", lambda s: F.struct(s.alias("v")))
    vectors = _with_states(docs).select(*_carried(docs), F.explode_outer(items).alias("item")).where(F.col("item").isNotNull())
    return vectors.select(*_carried(docs), F.col("item.v").alias("v")).select(
        *_carried(docs),
        v["icao24"].alias("icao24"),
        v["callsign"].alias("callsign"),
        _number(v["time_position"], "int").alias("time_position"),
        _number(v["longitude"], "float").alias("longitude"),
        _number(v["latitude"], "float").alias("latitude"),
        v["on_ground"].try_cast("boolean").alias("on_ground"),
        _number(v["true_track"], "double").alias("true_track"),
        _number(v["vertical_rate"], "double").alias("vertical_rate"),
    )


def keyed_aircraft(docs: DataFrame) -> DataFrame:
    """One row per element of the keyed feed: ``a`` holds its fields as text, ``now`` the call's clock.

    Fields go through a text map because a missing field and an explicit null differ below. Read by
    path, a number is spelled in its shortest form (9 for 9.0); its value is the same.
    """
    parsed, text = _branches(docs)
    answer = F.from_json("payload", "now double, ac array<map<string,string>>")
    # For a plain explode Spark repeats the parse, and all that made the payload, in a filter below it.
    rows = text.withColumn("_p", answer).select(*_carried(docs), F.col("_p.now").alias("now"), F.explode_outer("_p.ac").alias("a"))
    if parsed is not None:
        aircraft = F.explode_outer(F.try_variant_get(FIELDS, "$.ac", "array<map<string,string>>")).alias("a")
        rows = parsed.select(*_carried(docs), F.try_variant_get(FIELDS, "$.now", "double").alias("now"), aircraft).unionByName(rows)
    return rows.where(F.col("a").isNotNull())


def map_keyed(docs: DataFrame, null_falls_back: bool = False, metric_rate: bool = False) -> DataFrame:
    """Rows of the keyed feed; aircraft without a position are dropped.

    ``vertical_rate`` is the barometric rate, or the geometric one where the
    barometric field is missing. A field that is present but null stays null unless
    ``null_falls_back``. ``metric_rate`` converts feet per minute to metres per second.
    """
    a = F.col("a")
    baro, geom = _number(a["baro_rate"], "double"), _number(a["geom_rate"], "double")
    present = F.map_contains_key("a", "baro_rate")
    rate = F.coalesce(baro, geom) if null_falls_back else F.when(present, baro).otherwise(geom)
    if metric_rate:
        rate = rate * FT_PER_MIN_IN_M_PER_S
    seen_at = F.col("now") / 1000 - _number(a["seen_pos"], "double")
    carried = [c for c in _carried(docs) if c != "now"]
    return (
        keyed_aircraft(docs)
        .select(
            *carried,
            a["hex"].alias("icao24"),
            clean_callsign(a["flight"]).alias("callsign"),
            seen_at.try_cast("int").alias("time_position"),
            _number(a["lon"], "float").alias("longitude"),
            _number(a["lat"], "float").alias("latitude"),
            a["alt_baro"].eqNullSafe(F.lit("ground")).alias("on_ground"),
            _number(a["track"], "double").alias("true_track"),
            rate.alias("vertical_rate"),
        )
        .where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    )


def unify_positions(docs: DataFrame, **keyed_options: bool) -> DataFrame:
    """Both feeds in one shape, with write time and snapshot time.

    The branch on ``source`` is a partition filter on landed documents, so each
    payload is read and parsed once.
    """
    rows = map_positional(docs.where(F.col("source") == K.POSITIONAL_SOURCE)).unionByName(
        map_keyed(docs.where(F.col("source") == K.KEYED_SOURCE), **keyed_options)
    )
    return rows.select(
        *POSITION_COLUMNS,
        F.current_timestamp().alias("created_at"),
        F.col("fetched_at").alias("updated_at"),
    )


def newest_call(docs: DataFrame) -> DataFrame:
    """One row: the source and time of the freshest call; on a tie the positional feed wins."""
    newest = docs.groupBy("source").agg(F.max("fetched_at").alias("fetched_at"))
    return (
        newest.where(F.col("fetched_at").isNotNull())
        .orderBy(F.desc("fetched_at"), F.col("source") != K.POSITIONAL_SOURCE)
        .limit(1)
    )


def freshest_snapshot(docs: DataFrame) -> DataFrame:
    """Documents of the freshest call.

    Only ``source`` and ``fetched_at`` are scanned to find it; payloads are read for
    that call alone, from its own partition when the documents are landed ones.
    """
    call = newest_call(docs).select(F.struct("source", "fetched_at")).scalar()
    mine = (F.col("source") == call["source"]) & (F.col("fetched_at") == call["fetched_at"])
    if "fetched_date" in docs.columns:
        mine &= F.col("fetched_date") == F.to_date(call["fetched_at"])
    return docs.where(mine)


def snapshot_faults(docs: DataFrame) -> DataFrame:
    """One row: documents, and those that cannot be mapped whole.

    ``no_list`` counts positional documents without a list of states and
    ``bad_vectors`` those with a state vector too short to hold every column.
    """
    states = F.col("states")
    positional = F.col("source") == K.POSITIONAL_SOURCE
    short = F.exists(states, lambda v: v.isNull() | (F.size(v) < K.VECTOR_MIN_LENGTH))
    return _with_states(docs).agg(
        F.count("*").alias("documents"),
        F.count_if(positional & states.isNull()).alias("no_list"),
        F.count_if(positional & short).alias("bad_vectors"),
    )
