"""Vectors between Spark and numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_whole(vector: Column) -> Column:
    """Whether a vector is there and every entry is a finite number."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def longest(df: DataFrame, column: str) -> int:
    """Entries of the longest vector; 0 for an empty table."""
    return df.agg(F.max(F.size(column))).first()[0] or 0


def padded(vector: Column, length: int, fill: Column) -> Column:
    """A shorter vector filled up at its end."""
    return F.concat(vector, F.array_repeat(fill, F.greatest(F.lit(0), length - F.size(vector))))


def as_matrix(column: pa.Array, length: int, kind: type = np.float64) -> np.ndarray:
    """Arrow lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, length)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and end of each stretch of equal values."""
    if len(keys):
        edge = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        yield from zip(edge[:-1], edge[1:], strict=True)
