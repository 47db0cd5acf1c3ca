"""Arriving files into a log, a current-state table, or a history table.

Each load runs to the end of what has arrived (``availableNow``) and can be started again: the
checkpoint replaces the high-water mark. Tables that are merged are partitioned by a hash bucket
of the key: a batch writes the buckets it touches into a new version folder, which Spark's success
marker commits, so readers never see half a batch. A batch that is repeated after a failure merges
to the same rows. ``buckets`` belongs to the table; another count is refused. Choose it so that a
bucket is about a gigabyte.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators.dedup import keep_first
from orderloom.operators.history import scd2_merge, scd2_schema
from orderloom.operators.merge import merge_ranked, with_bucket
from orderloom.sources.folders import committed, matching, number, remove
from orderloom.sources.sinks import empty, write_table

BUCKET = "key_bucket"


def read_arrivals(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """The parquet files below ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_stream(arrivals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every arriving row to the log at ``path``, each exactly once."""
    return (
        arrivals.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def upsert_stream(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[Column],
    buckets: int = 64,
) -> StreamingQuery:
    """Keep the first row per key under ``order_by`` at ``path``; late versions lose."""

    def fold(part: DataFrame | None, batch: DataFrame) -> DataFrame:
        if part is None:
            return keep_first(batch, keys, order_by)
        return merge_ranked(part, batch, keys, order_by)

    return _fold_stream(arrivals, path, checkpoint, keys, buckets, arrivals.schema, fold)


def guarded_upsert_stream(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[Column],
    by: str,
    ts: str,
    grace: str | None = None,
    buckets: int = 64,
) -> StreamingQuery:
    """:func:`upsert_stream` that refuses rows older than their store's mark, the newest ``ts`` of column ``by`` in earlier batches.

    ``grace`` is an interval by which rows may be late. A store without a mark loads whole; rows without a time are refused once it has one. What is
    refused is kept at ``path``, by batch, see :func:`refused_rows`. Marks are kept per batch, too, and written last: a batch that is repeated after a
    failure meets the marks it met before, so it refuses the same rows.
    """

    def fold(part: DataFrame | None, batch: DataFrame) -> DataFrame:
        if part is None:
            return keep_first(batch, keys, order_by)
        return merge_ranked(part, batch, keys, order_by)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _marks(spark, path, batch_id, batch.schema, by, ts)
        limit = F.col(_MARK) - F.expr(f"interval {grace}") if grace else F.col(_MARK)
        tagged = batch.join(marks.withColumnRenamed(by, _STORE), F.col(by).eqNullSafe(F.col(_STORE)), "left")
        tagged = tagged.withColumn(_KEPT, F.col(_MARK).isNull() | F.coalesce(F.col(ts) >= limit, F.lit(False))).persist()
        tagged.where(~F.col(_KEPT)).select(*batch.columns).write.mode("overwrite").parquet(f"{path}/refused/batch={batch_id}")
        kept = tagged.where(F.col(_KEPT)).select(*batch.columns)
        _fold(spark, kept, path, keys, buckets, batch.schema, fold)
        newest = marks.unionByName(kept.select(by, F.col(ts).alias(_MARK))).groupBy(by).agg(F.max(_MARK).alias(_MARK))
        newest.where(F.col(_MARK).isNotNull()).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")
        tagged.unpersist()
        for old in matching(spark, f"{path}/marks/batch=*"):
            if number(old) < batch_id - 1:
                remove(spark, old)

    return (
        arrivals.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_MARK, _STORE, _KEPT = "__mark", "__store", "__kept"


def _marks(spark: SparkSession, path: str, batch_id: int, schema: T.StructType, by: str, ts: str) -> DataFrame:
    """The marks that the batches before this one left: a row per store."""
    kind = T.StructType([T.StructField(by, schema[by].dataType), T.StructField(_MARK, schema[ts].dataType)])
    before = [b for b in committed(spark, f"{path}/marks/batch=*") if b < batch_id]
    return spark.read.schema(kind).parquet(f"{path}/marks/batch={max(before)}") if before else empty(spark, kind)


def refused_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows a guarded stream refused, with the ``batch`` they came in."""
    kept = sorted(committed(spark, f"{path}/refused/batch=*"))
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not kept:
        return empty(spark, stored)
    return spark.read.schema(stored).option("basePath", f"{path}/refused").parquet(*[f"{path}/refused/batch={b}" for b in kept])


def history_stream(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    updated_at: str,
    order_by: Sequence[Column],
    buckets: int = 64,
) -> StreamingQuery:
    """Versioned history at ``path``: each batch is one run over its newest row per key."""

    def fold(part: DataFrame | None, batch: DataFrame) -> DataFrame:
        return scd2_merge(part, keep_first(batch, keys, order_by), keys, updated_at)

    schema = scd2_schema(arrivals.schema, updated_at)
    return _fold_stream(arrivals, path, checkpoint, keys, buckets, schema, fold)


def _fold_stream(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    buckets: int,
    schema: T.StructType,
    fold: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> StreamingQuery:
    def apply(batch: DataFrame, _: int) -> None:
        _fold(batch.sparkSession, batch, path, keys, buckets, schema, fold)

    return (
        arrivals.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _fold(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int,
    schema: T.StructType,
    fold: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> None:
    versions, held = _current(spark, path, buckets)
    batch = with_bucket(batch, keys, buckets, BUCKET).persist()
    # At most ``buckets`` numbers.
    touched = {r[0] for r in batch.select(BUCKET).distinct().collect()}
    parts = [held[b] for b in sorted(touched) if b in held]
    part = spark.read.schema(schema).parquet(*parts) if parts else None
    merged = with_bucket(fold(part, batch.drop(BUCKET)), keys, buckets, BUCKET)
    version = max(versions, default=0) + 1
    write_table(merged, f"{path}/buckets={buckets}/version={version}", [BUCKET])
    batch.unpersist()
    _remove_superseded(spark, path, buckets, version)


def _bucket_count(spark: SparkSession, path: str) -> int | None:
    """The bucket count the table was made with; it is part of the folder names."""
    return next((number(p) for p in matching(spark, f"{path}/buckets=*")), None)


def _current(spark: SparkSession, path: str, buckets: int, before: int | None = None) -> tuple[set[int], dict[int, str]]:
    """Committed versions (up to ``before``) and, per bucket, the folder of the last of them that wrote it."""
    stored = _bucket_count(spark, path)
    if stored not in (None, buckets):
        raise ValueError(f"{path} has {stored} buckets, not {buckets}")
    base = f"{path}/buckets={buckets}"
    versions = {v for v in committed(spark, f"{base}/version=*") if before is None or v <= before}
    held: dict[int, tuple[int, str]] = {}
    for folder in matching(spark, f"{base}/version=*/{BUCKET}=*"):
        version = number(folder.rsplit("/", 1)[0])
        if version in versions:
            held[number(folder)] = max(held.get(number(folder), (0, "")), (version, folder))
    return versions, {b: folder for b, (_, folder) in held.items()}


def _remove_superseded(spark: SparkSession, path: str, buckets: int, version: int) -> None:
    """Remove what neither this version nor the one before it reads; a reader of that one goes on."""
    used = {f for v in (version - 1, version) for f in _current(spark, path, buckets, v)[1].values()}
    for folder in matching(spark, f"{path}/buckets={buckets}/version=*/{BUCKET}=*"):
        if folder not in used:
            remove(spark, folder)


def current_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` as of its last committed version, without its bucket column."""
    buckets = _bucket_count(spark, path)
    held = _current(spark, path, buckets)[1] if buckets else {}
    return spark.read.schema(schema).parquet(*sorted(held.values())) if held else empty(spark, schema)
