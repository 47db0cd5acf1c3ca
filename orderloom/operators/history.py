"""Versioned history (type 2): ``valid_from`` and ``valid_to`` beside the tracked columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import pieces
from orderloom.sources.folders import committed, matching, number, remove

FROM, TO, STATE, ID = "valid_from", "valid_to", "history_state", "history_id"


def scd2_schema(schema: T.StructType, updated_at: str) -> T.StructType:
    kind = schema[updated_at].dataType
    return T.StructType([*schema.fields, T.StructField(FROM, kind), T.StructField(TO, kind)])


def scd2_merge(
    history: DataFrame | None, current: DataFrame, key: Sequence[str], updated_at: str
) -> DataFrame:
    """History after one run over ``current``, which holds one row per key.

    A new key opens a row at its ``updated_at``; a newer ``updated_at`` closes the open row there
    and opens the next; an equal or older one changes nothing; a key missing from ``current``
    stays open. Closed rows pass through without a shuffle: only the open row of each key, at
    most one, meets the current rows, so the join has no hot key.
    """
    opened = current.withColumns({FROM: F.col(updated_at), TO: _empty(current, updated_at)})
    if history is None:
        return opened
    columns = opened.columns
    history = history.select(*columns)
    closed = history.where(F.col(TO).isNotNull())
    return closed.unionByName(_meet(history.where(F.col(TO).isNull()), opened, key, updated_at))


def _meet(history: DataFrame, opened: DataFrame, key: Sequence[str], updated_at: str) -> DataFrame:
    """Open rows of the history and the current rows, at most one per key on either side."""
    before = _side(history, key, opened.columns, "__old")
    after = _side(opened, key, opened.columns, "__new")
    on = reduce(
        lambda a, b: a & b, [F.col(f"__old_{k}").eqNullSafe(F.col(f"__new_{k}")) for k in key]
    )
    both = before.join(after, on, "full").select("__old", "__new")
    old, new = F.col("__old"), F.col("__new")
    changed = new.isNotNull() & (new[updated_at] > old[updated_at])
    ended = old.withField(TO, new[updated_at])
    rows = (
        F.when(old.isNull(), F.array(new))
        .when(changed, F.array(ended, new))
        .otherwise(F.array(old))
    )
    return both.select(F.inline(rows))


def scd2_run(
    spark: SparkSession, path: str, run: int, current: DataFrame, key: Sequence[str], updated_at: str, buckets: int = 64
) -> None:
    """One run over the history table at ``path``, which holds a folder per run; ``current`` has one row per key.

    Rows lie in files by the hash of their key, ``buckets`` of them, and Spark knows that, so only ``current`` is shuffled: the rows the run
    before left open meet it where they lie. The run writes those it closes and all that are open now; rows closed earlier are neither read nor written.
    Then the open rows of all runs but this one and the one before are removed, so the table stays below twice its live rows, and a reader of the run
    before goes on. ``run`` numbers, of 64 bits, must rise; ``buckets`` belongs to the table, and another count is refused. A task holds the rows of one bucket,
    so choose their count by the size of the feed (:func:`buckets_for`). Spark's success marker commits a
    run: one that broke off is not seen by readers and may be repeated.
    """
    base = _base(spark, path, buckets)
    runs = committed(spark, f"{base}/run=*")
    if any(r > run for r in runs):
        raise ValueError(f"run {run} of {path} comes after run {max(runs)}")
    before = max((r for r in runs if r < run), default=None)
    opened = _opened(current, key, updated_at, buckets)
    state = F.when(F.col(TO).isNull(), "open").otherwise("closed")
    with _bucketed(spark, opened.schema, f"{base}/run={before}/{STATE}=open", buckets) as old:
        if before is None:
            rows = opened
        else:
            rows = _rejoin(spark.table(old), opened, updated_at)
        folder, name = f"{base}/run={run}", _name()
        remove(spark, folder)
        writer = rows.withColumn(STATE, state).write.partitionBy(STATE).bucketBy(buckets, ID).sortBy(ID).option("compression", "zstd")
        try:
            writer.option("path", folder).mode("overwrite").saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    for superseded in runs - {before, run}:
        remove(spark, f"{base}/run={superseded}/{STATE}=open")


def _opened(current: DataFrame, key: Sequence[str], updated_at: str, buckets: int) -> DataFrame:
    """The current rows as open ones, dealt to the buckets. What the history adds to them is made after the shuffle, the key's text too."""
    dealt = current.repartition(buckets, key_id(key))
    return dealt.withColumns({FROM: F.col(updated_at), TO: _empty(current, updated_at), ID: key_id(key)})


def buckets_for(spark: SparkSession, path: str, least: int = 8) -> int:
    """A count of buckets for the history of a feed of the size of the files at ``path``: it rises with them, so that a bucket's rows fit a task."""
    return max(least, pieces(spark, path))


def key_id(key: Sequence[str]) -> Column:
    """A text that tells keys apart, NULLs included: the MD5 of their JSON."""
    return F.md5(F.to_json(F.struct(*key)))


def _rejoin(history: DataFrame, opened: DataFrame, updated_at: str) -> DataFrame:
    """Open rows of the history and the current rows, joined where the history lies."""
    columns = opened.columns
    old, new = F.col("old"), F.col("new")
    both = history.select(F.col(ID).alias("_old"), F.struct(*columns).alias("old")).join(
        opened.select(F.col(ID).alias("_new"), F.struct(*columns).alias("new")), F.col("_old") == F.col("_new"), "full"
    )
    changed = new.isNotNull() & (new[updated_at] > old[updated_at])
    rows = F.when(old.isNull(), F.array(new)).when(changed, F.array(old.withField(TO, new[updated_at]), new)).otherwise(F.array(old))
    return both.select(F.inline(rows))


def scd2_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The history :func:`scd2_run` keeps at ``path``: closed rows of all runs, open rows of the last. Empty before the first run."""
    base = next(iter(matching(spark, f"{path}/buckets=*")), None)
    runs = committed(spark, f"{base}/run=*") if base else set()
    if not runs:
        return spark.createDataFrame([], schema)
    closed = [f for f in matching(spark, f"{base}/run=*/{STATE}=closed") if number(f.rsplit("/", 1)[0]) in runs]
    places = [*matching(spark, f"{base}/run={max(runs)}/{STATE}=open"), *sorted(closed)]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def _base(spark: SparkSession, path: str, buckets: int) -> str:
    for there in matching(spark, f"{path}/buckets=*"):
        if number(there) != buckets:
            raise ValueError(f"{path} has {number(there)} buckets, not {buckets}")
    return f"{path}/buckets={buckets}"


def _name() -> str:
    return f"orderloom_history_{uuid.uuid4().hex}"


@contextmanager
def _bucketed(spark: SparkSession, schema: T.StructType, folder: str, buckets: int) -> Iterator[str]:
    """A name in the session's catalog for files of a run, which says in which buckets they lie; the files stay when it goes."""
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({ID}) SORTED BY ({ID}) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def scd2_current(history: DataFrame) -> DataFrame:
    """The open rows: what reports read."""
    return history.where(F.col(TO).isNull())


def scd2_as_of(history: DataFrame, ts: Column) -> DataFrame:
    """The rows valid at ``ts``: from inclusive, to exclusive."""
    return history.where((F.col(FROM) <= ts) & (F.col(TO).isNull() | (ts < F.col(TO))))


def _side(df: DataFrame, key: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"{name}_{k}") for k in key], F.struct(*columns).alias(name))


def _empty(df: DataFrame, like: str) -> Column:
    return F.lit(None).cast(df.schema[like].dataType)
