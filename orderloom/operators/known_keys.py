"""Which keys of a batch a growing table already holds, without reading the table: a persisted membership filter.

The filter is one bit per place of a hash space, kept as rows of (bucket, bitmap of 32,768 places); loads add rows, and rows of one bucket are
combined when read. A key whose bit is not set is new for certain. Only the others, repeats and a few chance agreements, meet the table, and of it only
the buckets of a committed table (``sources/versions.py``) that they fall into.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.merge import with_bucket
from orderloom.sources import versions
from orderloom.sources.folders import matching, number, remove

SCHEMA = "place_bucket bigint, bitmap binary"
#: Places of the hash space by default; about sixteen for each key keep chance agreements near six in a hundred.
PLACES = 1 << 36
_BITMAP = 1 << 15


def places_for(keys: int) -> int:
    """Places for a filter that will hold about so many keys: with far more, every key has a bitmap of its own."""
    return max(_BITMAP, 1 << (16 * keys - 1).bit_length())


def _place(keys: Sequence[str], places: int) -> Column:
    """The key's place, from 1; NULLs are part of a key."""
    parts = [part for k in keys for part in (F.col(k).isNull(), F.col(k))]
    return F.pmod(F.xxhash64(*parts), F.lit(places)) + 1


def add_keys(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], places: int = PLACES) -> None:
    """Add the keys of ``rows`` to the filter at ``path``; adding keys again changes nothing. ``places`` belongs to the filter."""
    base = _base(spark, path, places)
    _bits(rows.select(_place(keys, places).alias("place"))).write.mode("append").parquet(base)


def _bits(placed: DataFrame) -> DataFrame:
    """A bitmap per bucket. Places are shuffled, not bitmaps, which are 4 KB each however few bits they have."""
    dealt = placed.withColumn("place_bucket", F.bitmap_bucket_number("place")).repartition("place_bucket")
    return dealt.groupBy("place_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))


def compact(spark: SparkSession, path: str, places: int = PLACES) -> None:
    """One row per bucket again, after many loads; no writer may be at work."""
    base, fresh = _base(spark, path, places), f"{path}/fresh"
    _held(spark, base).write.mode("overwrite").parquet(fresh)
    spark.read.schema(SCHEMA).parquet(fresh).write.mode("overwrite").parquet(base)
    remove(spark, fresh)


def maybe_known(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], places: int = PLACES) -> DataFrame:
    """The rows whose key the filter may hold: all that it holds, and by chance a few more."""
    base = _base(spark, path, places)
    held = _held(spark, base)
    placed = rows.withColumn("__place", _place(keys, places))
    bit = F.bitmap_bit_position("__place")
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bitmap_bit_position(__place) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    joined = placed.join(held, F.bitmap_bucket_number("__place") == F.col("place_bucket"))
    is_set = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return joined.where(is_set).select(*rows.columns)


def check_new_keys(
    spark: SparkSession, table: str, path: str, batch: DataFrame, keys: Sequence[str], places: int = PLACES, message: str | None = None
) -> DataFrame:
    """Keys of ``batch`` that it holds twice or that the committed table at ``table`` holds already: the keys, ``row_count`` of both, ``error_message``.

    The filter at ``path`` must hold the table's keys (:func:`add_keys`). Keys match NULL-safely. The buckets to read are found from the possible
    repeats before this returns, so pass a written batch.
    """
    arriving = batch.groupBy(*keys).agg(F.count("*").alias("__rows"))
    held = versions.manifest(spark, table)
    repeats = arriving.select(*keys, F.col("__rows").alias("row_count")).where("row_count > 1")
    if held is not None and held.folders:
        maybe = maybe_known(spark, path, arriving, keys, places)
        # At most the table's count of buckets.
        touched = [r[0] for r in with_bucket(maybe, keys, held.buckets, "__bucket").select("__bucket").distinct().collect()]
        known = versions.read(spark, table, held.number, touched).select(*[F.col(k).alias(f"__{k}") for k in keys]).groupBy(*[f"__{k}" for k in keys]).agg(F.count("*").alias("__known"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        total = F.col("__rows") + F.coalesce(F.col("__known"), F.lit(0))
        repeats = arriving.join(known, same, "left").select(*keys, total.alias("row_count")).where("row_count > 1")
    return repeats.withColumn("error_message", F.lit(message or f"Duplicate rows for {', '.join(keys)}."))


def _held(spark: SparkSession, base: str) -> DataFrame:
    if not matching(spark, base):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(base).groupBy("place_bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _base(spark: SparkSession, path: str, places: int) -> str:
    for there in matching(spark, f"{path}/places=*"):
        if number(there) != places:
            raise ValueError(f"the filter at {path} has {number(there)} places, not {places}")
    return f"{path}/places={places}"
