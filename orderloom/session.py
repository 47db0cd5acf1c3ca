"""Session settings the library relies on, and the shared folder for checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE does the run-time work this library leans on: it splits skewed join partitions,
# coalesces small shuffle partitions and swaps in broadcast joins by measured size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows of a feed take far more memory than its files, so a task reads a small piece: what it sorts before a shuffle stays in memory.
    "spark.sql.files.maxPartitionBytes": "8m",
    # A write by store or bucket keeps a file open for each instead of sorting its rows; at the last of so many files it would begin to sort.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.ui.enabled": "false",
    # Wide plans make thousands of column calls; recording a call site for each costs seconds.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Bytes of a table's files whose rows, derived and shuffled, make about one partition that fits a task.
PIECE = 4 << 20
#: Bytes that a task writes where it makes a file per bucket.
TASK = 64 << 20


def build_session(app: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pieces(spark: SparkSession, path: str) -> int:
    """How many tasks' worth of rows the files at ``path`` hold, one at least."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return max(1, -(-system.getContentSummary(place).getLength() // PIECE))


def fit_input(spark: SparkSession, path: str) -> None:
    """Let a session that was built elsewhere read, shuffle and write a table of the size of ``path`` without spilling.

    Shuffles begin with a partition per piece of the table where that is more than they have; AQE merges small ones again.
    """
    largest = SETTINGS["spark.sql.files.maxPartitionBytes"]
    if _bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes")) > _bytes(spark, largest):
        spark.conf.set("spark.sql.files.maxPartitionBytes", largest)
    if int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 0:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", SETTINGS["spark.sql.maxConcurrentOutputFileWriters"])
    partitions = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    first = spark.conf.get(partitions, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if (wanted := pieces(spark, path)) > int(first):
        spark.conf.set(partitions, str(wanted))


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def is_broadcast(df: DataFrame) -> bool:
    """Whether Spark, by its estimate of the size of ``df``, broadcasts it to a join."""
    return _estimate(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def few_tasks(df: DataFrame) -> DataFrame:
    """``df``, without a shuffle, in tasks of some 64 MB by Spark's estimate, for a write that makes several files per task; while the cores suffice, of a
    piece each. What a task merges stays apart: its parts are read one after the other."""
    size = _estimate(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(min(max(1, min(cores, -(-size // PIECE)), -(-size // TASK)), 1 << 30))


@contextmanager
def drop_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a write within has shuffled is removed when it is done, not when the driver happens to collect its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _estimate(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below the cluster's ``spark.checkpoint.dir``.

    Only a session of one process may fall back to a temporary folder: on a cluster the executors
    could not see it, so there the missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="orderloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str = "cut", **options: str):
    """Write ``df`` to the shared folder, with the writer's ``options``, and read it back, ending its lineage there."""
    path = shared_folder(df.sparkSession, name)
    with drop_shuffles(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
