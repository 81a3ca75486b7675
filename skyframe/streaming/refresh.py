"""Refresh of the position table as a stream over the landing folder."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyframe import schemas
from skyframe.sources.positions import refresh_positions
from skyframe.sources.snapshots import read_snapshots

log = logging.getLogger(__name__)


def newest_per_source(documents: DataFrame) -> DataFrame:
    """Newest call per feed. Arrival order does not matter: a late, older document changes nothing.

    State is one timestamp per feed, so it needs no watermark to stay small.
    """
    return documents.groupBy("source").agg(F.max("fetched_at").alias("fetched_at"))


def stream_refresh(
    spark: SparkSession,
    folders: dict[str, str],
    table: str,
    checkpoint: str,
    root: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Replace the table after every cycle from the freshest snapshot.

    ``folders`` holds the landing folder of each feed; several feeds may share one. The
    stream carries call times only. The winning call's payloads are then read from
    their own partition. A cycle that is refused or fails for any other reason leaves the old
    table and is tried again on the next one, whether or not anything new has been landed: a
    clock runs along with the files. With ``availableNow`` or ``once`` there is no next cycle,
    and no clock.
    """
    trigger = trigger or {"processingTime": "20 seconds"}
    shared = sorted(set(folders.values()))
    stamps = None
    for folder in shared:
        one = spark.readStream.schema(schemas.BRONZE).parquet(folder).select("source", "fetched_at")
        stamps = one if stamps is None else stamps.unionByName(one)
    if "processingTime" in trigger:
        clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        stamps = stamps.unionByName(
            clock.select(F.lit(None).cast("string").alias("source"), F.lit(None).cast("timestamp").alias("fetched_at"))
        )
    done: list = [None]

    def cycle(newest: DataFrame, _epoch: int) -> None:
        # One row per feed.
        calls = sorted((r["source"], r["fetched_at"]) for r in newest.where("source IS NOT NULL AND fetched_at IS NOT NULL").collect())
        if not calls or calls == done[0]:
            return
        mine = F.lit(False)
        for source, at in calls:
            mine |= (F.col("source") == source) & (F.col("fetched_at") == F.lit(at)) & (F.col("fetched_date") == F.to_date(F.lit(at)))
        try:
            landed = None
            for folder in shared:
                one = read_snapshots(spark, folder).where(mine)
                landed = one if landed is None else landed.unionByName(one)
            refresh_positions(landed, table, root)
        except Exception as reason:  # noqa: BLE001 any failed cycle is tried again
            log.warning("%s keeps its old rows: %s", table, reason)
        else:
            done[0] = calls

    return (
        newest_per_source(stamps)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(cycle)
        .queryName(f"refresh_{table}")
        .trigger(**trigger)
        .start()
    )
