"""Multi-store scans: the store is not a column of the raw tables, it is which table a row is in."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.incremental import increment_by_store
from orderloom.operators.joins import with_lookup
from orderloom.sources.registry import STORE_NAMES, StoreSource


def read_location(spark: SparkSession, location: str) -> DataFrame:
    """A parquet path, or a table of the session's catalog."""
    return spark.read.parquet(location) if "/" in location else spark.table(location)


def read_stores(
    spark: SparkSession,
    sources: Sequence[StoreSource],
    platform: str,
    read: Callable[[SparkSession, str], DataFrame] = read_location,
) -> DataFrame:
    """The stores' tables as one, tagged with platform and upper-case store.

    A column that some stores lack is NULL for them. A filter on ``brand`` drops the other stores'
    scans at planning, and other filters reach every scan.
    """

    def one(source: StoreSource) -> DataFrame:
        df = read(spark, source.location).withColumnsRenamed(dict(source.rename))
        return df.withColumns({"source_platform": F.lit(platform), "brand": F.lit(source.brand.upper())})

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(s) for s in sources]
    )


def read_increment(
    spark: SparkSession,
    sources: Sequence[StoreSource],
    platform: str,
    marks: DataFrame | None,
    ts: str,
    inclusive: bool = True,
    floor: object = None,
    read: Callable[[SparkSession, str], DataFrame] = read_location,
) -> DataFrame:
    """:func:`read_stores`, but only rows the target does not have yet; see :func:`increment_by_store`.

    ``marks`` holds a mark per upper-case store (:func:`high_water` of the target by ``brand``); None is the first run.
    """
    stores = [(s.brand.upper(), read(spark, s.location).withColumnsRenamed(dict(s.rename))) for s in sources]
    return increment_by_store(stores, marks, "brand", ts, inclusive, floor).withColumn("source_platform", F.lit(platform))


def read_footers(spark: SparkSession, location: str) -> DataFrame:
    """A parquet table for its marks: Spark takes minima, maxima and counts from file footers and reads no data page.

    That holds for whole numbers, floats and dates, such as load times as epoch numbers, of the whole table or by all
    its partition columns. Spark has no such statistics for timestamps and text; it then reads those columns alone.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    with _setting(spark, "spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text"):
        return spark.read.parquet(location)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_statement_feeds(
    spark: SparkSession,
    registry: Mapping[str, Sequence[StoreSource]],
    platform: str,
    marks: DataFrame | None = None,
    read: Callable[[SparkSession, str], DataFrame] = read_location,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three linked statement feeds: headers, transactions, fee breakdowns; all from one mark per store on, if there are marks."""
    feeds = ("statement_headers", "statement_transactions", "statement_breakdowns")
    headers, transactions, breakdowns = (read_increment(spark, registry[f], platform, marks, "batch_runtime", read=read) for f in feeds)
    return headers, transactions, breakdowns


def brand_map(spark: SparkSession, names: Mapping[str, str] = STORE_NAMES) -> DataFrame:
    """Store codes and display names as a relation."""
    return spark.createDataFrame(list(names.items()), "brand string, brand_full string")


def with_brand_name(df: DataFrame, names: Mapping[str, str] = STORE_NAMES) -> DataFrame:
    """``brand_full``: the store's display name, or its code when it has none."""
    return with_lookup(df, "brand", names, "brand_full")
