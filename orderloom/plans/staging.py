"""Steps every staging pipeline shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.times import as_utc, day, from_millis, to_millis

BATCH = ["batch_id", "batch_runtime", "batch_user_id", "batch_date", "ds"]


def with_load_time(df: DataFrame) -> DataFrame:
    """The load columns in one shape for both connectors.

    One connector stamps rows with ``batch_runtime`` (epoch ms) and a batch id, the other with
    ``extracted_at``.
    """
    if "extracted_at" in df.columns:
        df = as_utc(df, "extracted_at").withColumns(
            {
                "batch_id": F.lit(None).cast("string"),
                "batch_runtime": to_millis(F.col("extracted_at")),
                "batch_user_id": F.lit(None).cast("string"),
                "batch_date": F.col("extracted_at"),
            }
        ).drop("extracted_at")
    else:
        df = add_missing(df, ["batch_id", "batch_user_id"])
        df = df.withColumn("batch_date", from_millis(F.col("batch_runtime")))
    return df.withColumn("ds", day(F.col("batch_date")))


def add_missing(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """``df`` with typed NULLs for the columns it lacks."""
    missing = {c: F.lit(None).cast(kind) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df
