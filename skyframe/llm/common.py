"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyframe import session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers started from now on look for this package where the driver found it."""
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_of(df: DataFrame, *more: tuple[str, T.DataType]) -> T.StructType:
    """The columns of ``df``, then the named ones."""
    return T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in more]])


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 of each text, a null as empty, one at a time and without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        yield from (b"" for _ in range(len(column)))
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    view = memoryview(data)
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield bytes(view[at[i] : at[i + 1]]) if valid is None or valid[i] else b""


def batch_of(source: pa.RecordBatch, names: list[str], **more: pa.Array) -> pa.RecordBatch:
    """Columns of ``source`` by name, then new ones."""
    arrays = [source.column(source.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *more.values()], [*names, *more])


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``session.materialise``, after which the shuffle files of the write go at once.

    The written table cuts lineage, so nothing needs them any more. If executors are lost while
    the write runs, its own stages are run again as usual.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return session.materialise(df, label)
    finally:
        conf.set(key, before)
