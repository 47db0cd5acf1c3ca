"""Folders of a table that keeps one folder per version: which are committed, and removing superseded ones."""

from __future__ import annotations

from pyspark.sql import SparkSession


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match the glob ``pattern``, on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def number(folder: str) -> int:
    """The value of a folder named ``name=value``."""
    return int(folder.rsplit("=", 1)[1])


def committed(spark: SparkSession, pattern: str) -> set[int]:
    """Numbers of the folders ``name=number`` in which Spark has left its success marker."""
    return {number(p.rsplit("/", 1)[0]) for p in matching(spark, f"{pattern}/_SUCCESS")}


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
