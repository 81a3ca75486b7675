"""Landing of raw feed snapshots: check, stamp, append, read back, expire."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe import schemas
from skyframe.functions.columns import instant
from skyframe.operators.unify import with_fields
from skyframe.sources import files

Transform = Callable[[DataFrame], DataFrame]


# A payload that holds nothing, and one that opens a list or an object.
EMPTY = r"^\s*(null|\[\s*\]|\{\s*\})\s*$"
LIST, CONTAINER = r"^\s*\[", r"^\s*[\[{]"


def is_json(payload: Column) -> Column:
    """Whether a text is one whole JSON value, of any size; repeated fields and NaN are allowed.

    The text becomes the first of two fields, the second named after its digest. If both are
    found and nothing else, the text neither breaks off nor goes on behind its value.
    """
    name = F.sha1(F.encode(payload, "utf-8"))
    fields = F.from_json(F.concat(F.lit('{"value":'), payload, F.lit(',"'), name, F.lit('":0}')), "map<string,string>")
    return F.coalesce((F.size(fields) == 2) & F.map_contains_key(fields, name), F.lit(False))


def parse_guard(raw: DataFrame) -> DataFrame:
    """Add ``reason``, why a payload is not stored; null when it is.

    The text is parsed once to see that it is JSON; the other checks look at its edges.
    """
    payload = F.col("payload")
    return raw.withColumn(
        "reason",
        F.when(payload.rlike(EMPTY), "empty")
        .when(~is_json(payload) | payload.isNull(), "invalid_json")
        .when(~payload.rlike(CONTAINER), "unexpected_type"),
    )


def accepted(guarded: DataFrame) -> DataFrame:
    return guarded.where(F.col("reason").isNull()).drop("reason")


def rejected(guarded: DataFrame) -> DataFrame:
    return guarded.where(F.col("reason").isNotNull())


def one_document_per_row(docs: DataFrame) -> DataFrame:
    """A list payload holds several documents of one call; each becomes a row."""
    items = F.when(F.col("payload").rlike(LIST), F.from_json("payload", "array<string>")).otherwise(
        F.array("payload")
    )
    rest = [c for c in docs.columns if c != "payload"]
    return docs.select(*rest, F.explode(items).alias("payload")).where(F.col("payload").isNotNull())


def stamp(docs: DataFrame, source: str, run_id: str) -> DataFrame:
    """Add the audit columns. A frame that brings its own ``fetched_at`` keeps it."""
    if "fetched_at" in docs.columns:
        fetched = instant("fetched_at", docs.schema["fetched_at"].dataType.simpleString())
    else:
        fetched = F.current_timestamp()
    return (
        docs.withColumn("fetched_at", fetched)
        .withColumn("load_date", F.current_timestamp())
        .withColumn("pipeline_run_id", F.lit(run_id))
        .withColumn("source", F.lit(source))
        .withColumn("fetched_date", F.to_date("fetched_at"))
    )


def prepare(raw: DataFrame, source: str, run_id: str, transform: Transform | None = None, parse: bool = False) -> DataFrame:
    """Everything between a raw payload and the stored row; the same for batch and stream.

    With ``parse``, rows carry their payload's fields too, and ``transform`` must keep both alike, as trimming does.
    """
    docs = one_document_per_row(accepted(parse_guard(raw)))
    if parse:
        docs = with_fields(docs)
    if transform is not None:
        docs = docs.transform(transform)
    return stamp(docs, source, run_id)


def land_snapshots(
    raw: DataFrame,
    path: str,
    source: str,
    run_id: str,
    transform: Transform | None = None,
    key: Sequence[str] = (),
    rebalance: bool = False,
    parse: bool = False,
) -> DataFrame:
    """Append payloads to the landing folder; rows whose ``key`` is already stored are skipped.

    ``raw`` has a ``payload`` text column, optionally ``fetched_at`` and key columns.
    Equal payloads are told by the digest that every landed row carries, so stored payloads are
    not read again; with ``fetched_at`` in the key and in ``raw``, only the days of ``raw`` are
    read. Null key values are equal to each other, so a row with one lands once.
    ``rebalance`` suits a backfill whose tasks each hold many days: days are brought
    together first, and Spark splits the heavy ones, so the folder gets few, even
    files. ``parse`` stores the fields of each payload beside it, as a variant; a payload that is
    trimmed then is spelled anew, so a folder should keep to one way if ``key`` holds the payload.
    Returns the landed rows of this source.
    """
    spark = raw.sparkSession
    docs = prepare(raw, source, run_id, transform, parse)
    if key:
        docs = with_digest(docs)
        names = [DIGEST if c == "payload" else c for c in key]
        docs = docs.dropDuplicates(names)
        if files.exists(spark, f"{path}/source={source}"):
            days = days_of(raw) if {"fetched_at"} <= set(key) & set(raw.columns) else None
            docs = without_stored(docs, stored_keys(spark, path, source, names, days), names)
    if rebalance:
        docs = docs.hint("rebalance", "fetched_date")
    append_batch(docs, path, uuid.uuid4().hex)
    return read_snapshots(spark, path, source, parsed=parse)


DIGEST = "payload_digest"


def with_digest(docs: DataFrame) -> DataFrame:
    """Add the digest of the stored payload, unless it is there."""
    return docs if DIGEST in docs.columns else docs.withColumn(DIGEST, F.sha2("payload", 256))


def days_of(raw: DataFrame) -> list:
    """The days on which calls of ``raw`` were made: one value per day reaches the driver."""
    day = F.to_date(instant("fetched_at", raw.schema["fetched_at"].dataType.simpleString()))
    return [r[0] for r in raw.select(day.alias("day")).distinct().collect()]


def stored_keys(spark: SparkSession, path: str, source: str, names: Sequence[str], days: list | None = None) -> DataFrame:
    """The named columns of what has landed for a source, on these days if given.

    Rows that landed without a digest get it from their payload.
    """
    stored = spark.read.option("mergeSchema", True).parquet(path).where(F.col("source") == source)
    if days is not None:
        known = F.col("fetched_date").isin([d for d in days if d is not None]) if any(days) else F.lit(False)
        stored = stored.where(known | F.col("fetched_date").isNull() if None in days else known)
    if DIGEST not in stored.columns:
        stored = with_digest(stored)
    return stored.select(*names)


def without_stored(docs: DataFrame, stored: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored; nulls are equal to nulls."""
    renamed = stored.select(*[F.col(c).alias(f"_stored_{c}") for c in names])
    return docs.join(renamed, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_stored_{c}")) for c in names]), "left_anti")


def append_batch(docs: DataFrame, path: str, batch: str) -> None:
    """Write prepared rows as one batch of the landing folder.

    Every batch has folders of its own below its days. Written again under the same name, it
    replaces itself, so a stream may repeat a batch; streams, batches and retention share a folder.
    """
    named = with_digest(docs).withColumn("batch", F.lit(f"b-{batch}"))
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("source", "fetched_date", "batch").parquet(path)


def read_snapshots(
    spark: SparkSession,
    path: str,
    source: str | None = None,
    newest_first: bool = False,
    now: Column | None = None,
    hours: int | None = None,
    parsed: bool = False,
) -> DataFrame:
    """Landed documents, of one source if named (only its partitions are listed and read).

    With ``hours``, only those still inside that retention window, to the second. With ``parsed``,
    also their fields; documents that landed without are read as text by what follows.
    """
    schema = schemas.BRONZE_PARSED if parsed else schemas.BRONZE
    docs = spark.read.schema(schema).parquet(path).select(*schema.names)
    if source is not None:
        docs = docs.where(F.col("source") == source)
    if hours is not None:
        docs = unexpired(docs, now, hours)
    return docs.orderBy(F.desc("fetched_at")) if newest_first else docs


def unexpired(docs: DataFrame, now: Column | None = None, hours: int = K.RETENTION_HOURS) -> DataFrame:
    """Documents still inside the retention window. Those without a true date never expire."""
    now = F.current_timestamp() if now is None else now
    horizon = now - F.make_dt_interval(hours=F.lit(hours))
    return docs.where(F.col("fetched_at").isNull() | (F.col("fetched_at") >= horizon))


def drop_expired(
    spark: SparkSession, path: str, now: datetime | None = None, hours: int = K.RETENTION_HOURS
) -> list[str]:
    """Delete the day partitions that lie wholly before the retention window.

    Readers hide the rest of the boundary day through ``unexpired``. Only folder
    names are listed on the driver, never rows.
    """
    now = now or datetime.now(timezone.utc)
    keep_from = (now - timedelta(hours=hours)).date().isoformat()
    dropped = []
    for _, folder in files.matching(spark, f"{path}/source=*/fetched_date=*"):
        day = folder.rsplit("=", 1)[1]
        if day[0].isdigit() and day < keep_from:
            files.delete(spark, folder)
            dropped.append(folder)
    return sorted(dropped)
