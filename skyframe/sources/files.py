"""Folder housekeeping through Hadoop's file API, so that any storage Spark reads works. Names only, never rows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[tuple[int, str]]:
    """(modification time, path) of everything a glob pattern matches, oldest first."""
    files, target = _files(spark, pattern)
    found = files.globStatus(target) or []
    return sorted((s.getModificationTime(), s.getPath().toString()) for s in found)


def delete(spark: SparkSession, path: str) -> None:
    files, target = _files(spark, path)
    files.delete(target, True)
