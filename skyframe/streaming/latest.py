"""The newest row per aircraft, followed over all that lands, by keyed state that expires.

State is one pair of numbers per (icao24, callsign), kept for a bucket of keys together, as a call of
a Python function costs as much as hundreds of keys. Each cycle appends the rows that became newest, and a mark for each key that nothing was heard of for the time to live, so neither a cycle
nor a reader of it ever goes over the whole history of positions.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skyframe import constants as K
from skyframe.session import ship_package
from skyframe.sources import files

KEY = ["icao24", "callsign"]
ORDER = ["major", "minor"]
CHANGE = "icao24 string, callsign string, major long, minor long, row string"
#: A row travels as one text, with instants to the microsecond.
AS_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
NULL_IS_NEWEST, NULL_IS_OLDEST = (1 << 63) - 1, -(1 << 63)
KEEP = timedelta(hours=K.RETENTION_HOURS)
#: Buckets that keys are dealt to by hash; fixed, as the state of a checkpoint is kept by them.
BUCKETS = 1024


def _newest_of_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per key of each Arrow batch, so that a key with much of the input hardly travels."""
    for frame in frames:
        yield frame.sort_values(ORDER, ascending=False).drop_duplicates(KEY)


def newest_changes(rows: DataFrame, keep: timedelta = KEEP) -> DataFrame:
    """Rows of a stream that become the newest of their (icao24, callsign), in the shape of ``CHANGE``.

    Order is that of ``latest_per_aircraft``: a null ``time_position`` is newest, then the higher
    ``id``. Null keys are keys. A key that sends no row for ``keep`` is forgotten, and a change
    without a ``row`` says so; what it sends later starts it anew.
    """
    wait = int(keep.total_seconds() * 1000)
    packed = rows.select(
        *KEY,
        F.coalesce(F.col("time_position").cast("long"), F.lit(NULL_IS_NEWEST)).alias("major"),
        F.coalesce(F.col("id").cast("long"), F.lit(NULL_IS_OLDEST)).alias("minor"),
        F.to_json(F.struct(*rows.columns), AS_TEXT).alias("row"),
        F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).alias("bucket"),
    )

    def settle(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        # Of each key its place in the order and the time from which it is forgotten.
        held: dict[tuple, tuple] = pickle.loads(state.get[0]) if state.exists else {}
        changes: dict[tuple, tuple] = {}
        for frame in () if state.hasTimedOut else frames:
            for icao24, callsign, major, minor, row in zip(*[frame[c].tolist() for c in [*KEY, *ORDER, "row"]], strict=True):
                key = tuple(k if isinstance(k, str) else None for k in (icao24, callsign))
                place = held[key][0] if key in held else None
                if place is None or (major, minor) > place:
                    place = major, minor
                    changes[key] = major, minor, row
                held[key] = place, now + wait
        for key in [k for k, (_, until) in held.items() if until < now]:
            del held[key]
            changes[key] = None, None, None
        if held:
            state.update((pickle.dumps(held, 5),))
            state.setTimeoutDuration(max(1, min(until for _, until in held.values()) - now))
        elif state.exists:
            state.remove()
        if changes:
            columns = zip([*KEY, *ORDER, "row"], zip(*[(*k, *v) for k, v in changes.items()], strict=True), strict=True)
            # Nullable whole numbers: a double would round the largest.
            yield pd.DataFrame({c: pd.Series(v, dtype="Int64" if c in ORDER else "object") for c, v in columns})

    reduced = packed.mapInPandas(_newest_of_batches, packed.schema)
    return reduced.groupBy("bucket").applyInPandasWithState(
        settle, CHANGE, "keys binary", "update", GroupStateTimeout.ProcessingTimeTimeout
    )


def stream_latest(
    rows: DataFrame, folder: str, checkpoint: str, keep: timedelta = KEEP, trigger: dict | None = None
) -> StreamingQuery:
    """Append what changes among the newest rows of the stream ``rows`` to ``folder``.

    A cycle writes a folder of its own. Repeated after a failure, it replaces it. With
    ``availableNow`` or ``once``, keys expire in cycles that have rows.
    """
    ship_package(rows.sparkSession)

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/cycle={number}")

    trigger = trigger or {"availableNow": True}
    writer = (
        newest_changes(rows, keep)
        .writeStream.outputMode("update")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if "processingTime" in trigger:
        return writer.start()
    # Waiting for clocks, state would ask for one empty cycle after another and a run would not end.
    conf, idle = rows.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(idle)
    conf.set(idle, "false")
    try:
        return writer.start()
    finally:
        conf.set(idle, before)


def read_latest(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The newest row per (icao24, callsign) that has not expired; of the columns in ``schema``.

    Equal to ``latest_per_aircraft`` of all rows streamed so far, in whatever order and however
    late they came, as long as nothing has expired. Of each key the last cycle counts; tasks keep
    one change per key before they shuffle.
    """
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    changes = spark.read.schema(f"{CHANGE}, cycle long").parquet(folder)
    w = Window.partitionBy(*KEY).orderBy(F.desc("cycle"))
    last = changes.withColumn("_rank", F.row_number().over(w)).where("_rank = 1 AND row IS NOT NULL")
    return last.select(F.from_json("row", schema, AS_TEXT).alias("r")).select("r.*")


def compact_latest(spark: SparkSession, folder: str, target: str) -> None:
    """Write the changes that still count to ``target``, with their cycles, for readers that start from there.

    Changes that newer ones replaced and keys that expired are left out. Later cycles may be
    copied behind them, as their numbers go on.
    """
    changes = spark.read.schema(f"{CHANGE}, cycle long").parquet(folder)
    w = Window.partitionBy(*KEY).orderBy(F.desc("cycle"))
    last = changes.withColumn("_rank", F.row_number().over(w)).where("_rank = 1 AND row IS NOT NULL").drop("_rank")
    last.write.mode("overwrite").partitionBy("cycle").parquet(target)
