"""Writers and the schema step in front of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import drop_shuffles


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns, order and types of ``schema``.

    Missing columns come as typed NULLs, others are dropped.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def drop_pii(df: DataFrame, columns: Sequence[str], allow: Sequence[str] = ()) -> DataFrame:
    """``df`` without the named columns, except those in ``allow``."""
    return df.drop(*[c for c in columns if c not in allow])


def with_audit(df: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    """The run that built a row and when it did."""
    return df.withColumns(
        {"last_built_at": now if now is not None else F.current_timestamp(), "run_id": F.lit(run_id)}
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full rebuild at ``path``, which must not be read by ``df``.

    A partitioned write is rebalanced first: AQE then merges small output pieces and splits those of a
    store or day that holds much of the data, so no task writes a whole partition alone.
    """
    with drop_shuffles(df.sparkSession):
        _writer(df, partition_by).mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``."""
    writer = _writer(df, partition_by).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_increment(
    df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Append ``df`` to the table at ``path``.

    With the target's ``schema`` its columns keep their types and those ``df`` lacks are NULL; columns new in ``df``
    are added behind them. Earlier rows read them as NULL (:func:`read_table`).
    """
    rows = df
    if schema:
        new = [f for f in df.schema.fields if f.name not in schema.names]
        rows = conform(df, T.StructType([*schema.fields, *new]))
    _writer(rows, partition_by).mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table whose files may have been written under older schemas.

    With a declared schema the files' footers are not merged: a column a file lacks is NULL.
    """
    if schema:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def _writer(df: DataFrame, partition_by: Sequence[str]):
    if not partition_by:
        return df.write.option("compression", "zstd")
    return df.hint("rebalance", *partition_by).write.option("compression", "zstd").partitionBy(*partition_by)
