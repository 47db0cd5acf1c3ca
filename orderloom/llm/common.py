"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import cut_lineage, shared_folder

#: The six white-space characters that part words, and the words between them.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

__all__ = ["GAP", "SPACES", "WORD", "cut_lineage", "cut_large_rows", "partitions", "read_table", "shared_folder", "small_batches", "whole_text"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions, the number of tasks its user sized for the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut_large_rows(df: DataFrame, name: str) -> DataFrame:
    """:func:`cut_lineage` for rows of megabytes: pages and row groups end after a row where the writer would else first look after a hundred."""
    path = shared_folder(df.sparkSession, name)
    checks = {f"parquet.{part}.size.row.check.min": "1" for part in ("page", "block")} | {f"parquet.{part}.size.row.check.max": "1" for part in ("page", "block")}
    df.write.options(**checks, **{"parquet.enable.dictionary": "false", "parquet.block.size": str(8 << 20)}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Batches of about this size to Python for jobs run inside: rows of large binaries else fill batches of 64 MB, held twice or more."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)
