"""Helpers for checked queries: plain output types in Spark, and the matching SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Times and dates as text, decimals as doubles, whole numbers as bigint."""

    def column(field: T.StructField):
        kind, col = field.dataType, F.col(field.name)
        if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
            col = col.cast("string")
        elif isinstance(kind, T.DecimalType):
            col = col.cast("double" if kind.scale else "string")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        return col.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def store(key: str) -> str:
    return f"('STORE_' || substr('ABCDEF', ({key} % 6 + 1)::int, 1))"


def money(value: str) -> str:
    """The decimal a double's shortest text rounds to, half up."""
    return f"cast(cast(({value}) as varchar) as decimal(38,2))"


def pacific(ts: str) -> str:
    return f"timezone('America/Los_Angeles', timezone('UTC', {ts}))"


#: Line items with the columns the derived feeds add.
LINES = f"""
    select *, {store('l_orderkey')} as brand, cast(l_orderkey as varchar) as order_id,
           cast(l_linenumber as varchar) as line_id, cast(l_suppkey as varchar) as batch_id,
           l_shipdate + to_seconds(l_partkey::int) as loaded_at,
           'SKU-' || l_partkey as sku
    from lineitem
"""
MOVED = "('STORE_A', 'STORE_C', 'STORE_E')"
