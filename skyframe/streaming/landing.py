"""Landing as a stream: one query per feed, so that one feed's failure leaves the other running."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyframe import constants as K
from skyframe.operators.unify import bbox_trim
from skyframe.sources.snapshots import Transform, append_batch, prepare


def trim_payload(docs):
    return bbox_trim(docs).drop("ac_total", "ac_kept")


# Only the keyed feed answers for a circle, so only its payloads are trimmed to the box.
FEED_TRANSFORMS: dict[str, Transform | None] = {
    K.POSITIONAL_SOURCE: None,
    K.KEYED_SOURCE: trim_payload,
}


def stream_land(
    spark: SparkSession,
    drop_folder: str,
    path: str,
    source: str,
    run_id: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_trigger: int = 1000,
    whole_files: bool = False,
    parse: bool = False,
) -> StreamingQuery:
    """Land files dropped by a collector: a JSON payload per line, or per file if ``whole_files``.

    The call time is the file's modification time. A batch is named after the checkpoint and its
    number and replaces itself when it is written again, so a restarted query neither loses nor
    repeats documents. Several feeds, streams and batch landing may share one ``path``. ``parse``
    stores the fields of each payload beside it.
    """
    name = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def land(batch: DataFrame, number: int) -> None:
        append_batch(prepare(batch, source, run_id, FEED_TRANSFORMS.get(source), parse), path, f"{name}-{number}")

    raw = (
        spark.readStream.format("text")
        .option("wholetext", whole_files)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(drop_folder)
        .select(
            F.col("value").alias("payload"),
            F.col("_metadata.file_modification_time").cast("timestamp").alias("fetched_at"),
        )
    )
    return (
        raw.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .queryName(f"land_{source}_{run_id}")
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
