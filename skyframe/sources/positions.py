"""The position table: all-or-nothing refresh and allow-listed reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe import schemas
from skyframe.operators.live import duplicate_keys
from skyframe.operators.unify import newest_call, snapshot_faults, unify_positions
from skyframe.session import new_folder
from skyframe.sources import files


class RefreshRefused(RuntimeError):
    """The new snapshot cannot replace the table; the old one stays."""


def check_table(name: str) -> str:
    if name not in K.POSITION_TABLES:
        raise ValueError(f"position table must be one of {K.POSITION_TABLES}, got {name!r}")
    return name


def with_identity(rows: DataFrame) -> DataFrame:
    """Table layout with a unique ``id`` per row."""
    typed = rows.withColumn("id", F.monotonically_increasing_id())
    return typed.select(*[F.col(f.name).cast(f.dataType) for f in schemas.POSITIONS])


def versions_root(spark: SparkSession, root: str | None = None) -> str:
    """Where versions of the tables live: the warehouse, if no folder is named."""
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/positions"


def live_version(spark: SparkSession, table: str) -> str | None:
    """The folder that the table's view points at."""
    if not spark.catalog.tableExists(check_table(table)):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'").first()
    found = re.search(r"parquet\.`([^`]+)`", described["data_type"] if described else "")
    return found[1] if found else None


def publish_positions(rows: DataFrame, table: str, root: str | None = None) -> str:
    """Write a new version beside the old one, check it, then point the table's view at it.

    The swap is a single catalog update, so a reader sees the old rows or the new
    ones. A version with a repeated (icao24, time_position) is refused.
    """
    check_table(table)
    spark = rows.sparkSession
    path = new_folder(spark, table, versions_root(spark, root))
    with_identity(rows).write.parquet(path)
    written = spark.read.schema(schemas.POSITIONS).parquet(path)
    repeated = duplicate_keys(written).count()
    if repeated:
        files.delete(spark, path)
        raise RefreshRefused(f"{repeated} repeated (icao24, time_position) keys")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM parquet.`{path}`")
    return path


def refresh_positions(docs: DataFrame, table: str, root: str | None = None, **keyed_options: bool) -> str:
    """Replace the table from the freshest landed snapshot."""
    call = newest_call(docs).first()
    if call is None:
        raise RefreshRefused("no snapshot has been landed")
    newest = docs.where((F.col("source") == call["source"]) & (F.col("fetched_at") == F.lit(call["fetched_at"])))
    if "fetched_date" in docs.columns:
        newest = newest.where(F.col("fetched_date") == F.to_date(F.lit(call["fetched_at"])))
    faults = snapshot_faults(newest).first()
    if faults["no_list"] or faults["bad_vectors"]:
        raise RefreshRefused(
            f"{faults['no_list']} documents without states, {faults['bad_vectors']} with short vectors"
        )
    return publish_positions(unify_positions(newest, **keyed_options), table, root)


def drop_old_versions(spark: SparkSession, table: str, root: str | None = None, keep: int = 3) -> list[str]:
    """Delete versions older than the live one, but for the newest ``keep - 1`` of them.

    The live version is the one the view points at. It and anything newer, which may still be
    being written, always stay; what a failed write left behind goes once a newer version is live.
    """
    live = live_version(spark, table)
    if live is None:
        return []
    found = [path for _, path in files.matching(spark, f"{versions_root(spark, root)}/{check_table(table)}-*")]
    names = [path.rstrip("/").rsplit("/", 1)[1] for path in found]
    name = live.rstrip("/").rsplit("/", 1)[1]
    if name not in names:
        return []
    older = found[: names.index(name)]
    old = older[: len(older) - (max(keep, 1) - 1)]
    for path in old:
        files.delete(spark, path)
    return old


def read_positions(spark: SparkSession, table: str = K.POSITION_TABLES[0]) -> DataFrame:
    return spark.table(check_table(table))
