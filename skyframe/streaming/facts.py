"""The observation history as a table that grows by what has landed since."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyframe import schemas
from skyframe.operators.star import newest_observation, observations, resolve_airline


def append_observations(batch: DataFrame, path: str, name: str) -> None:
    """Write the observations of some documents as one batch, by day; written again, it replaces itself."""
    rows = observations(batch).withColumn("observed_date", F.to_date("observed_at")).withColumn("batch", F.lit(f"b-{name}"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("observed_date", "batch").parquet(path)


def stream_fact_states(spark: SparkSession, landing: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the observations of files that landed since the last run; history is not read again.

    The checkpoint knows the files. A batch that is repeated after a failure replaces its own
    folders, so nothing is lost or doubled. What late documents add to an earlier call stands in
    a later batch; ``read_fact_states`` settles which row counts.
    """
    name = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    docs = spark.readStream.schema(schemas.BRONZE).parquet(landing)
    return (
        docs.writeStream.foreachBatch(lambda batch, number: append_observations(batch, path, f"{name}-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_fact_states(
    spark: SparkSession, path: str, dim_aircraft: DataFrame, dim_airlines: DataFrame, since: str | None = None
) -> DataFrame:
    """The history, key (icao24, observed_at), airline resolved; from a day on if ``since`` is given.

    Equal to ``build_fact_states`` of all documents, however they were cut into batches: the
    newest row of a key among batches is the newest of all.
    """
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.where(F.col("observed_date") >= F.lit(since).cast("date"))
    return resolve_airline(newest_observation(rows.drop("observed_date", "batch")), dim_aircraft, dim_airlines)
