"""One row per business key out of an append-only version log.

``row_number() = 1`` lets Catalyst put a WindowGroupLimit in front of the shuffle: every map
task keeps one row per key, so a key that holds a large part of the table reaches the reducer
as one row per task, never as one huge group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order_by``; NULL keys form a group of their own.

    State NULL placement in ``order_by`` and end it with a unique column, so that the pick does
    not depend on how the rows are spread over tasks.
    """
    window = W.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def keep_latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """Latest version: columns of ``order`` descending, missing values last."""
    return keep_first(df, keys, [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order])


def row_hash(df: DataFrame) -> Column:
    """A hash of the row, to end an order with: rows that tie on it, too, hold the same values.

    It reads every column, so select what is needed first. Maps and variants have no hash and are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return F.xxhash64(*[F.col(f"`{n}`") for n, kind in kinds.items() if "map<" not in kind and "variant" not in kind])


def keep_earliest(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str], tie_break: Sequence[Column] = ()
) -> DataFrame:
    """Earliest version: columns of ``order`` ascending, missing values last, then ``tie_break``."""
    return keep_first(df, keys, [*[F.col(c).asc_nulls_last() for c in order], *tie_break])


def first_and_last(
    df: DataFrame,
    keys: Sequence[str],
    first: tuple[Sequence[str], Column],
    last: tuple[Sequence[str], Column],
) -> DataFrame:
    """The earliest and the latest version of each key in one pass, as structs ``first``, ``last``.

    Each of ``first`` and ``last`` is (columns to keep, ordering struct). One scan and one shuffle
    replace two picks and a self join, and the partial aggregate keeps one row per key and map
    task. Ordering structs compare field by field; see :func:`ordering`.
    """
    first_columns, first_order = first
    last_columns, last_order = last
    return df.groupBy(*keys).agg(
        F.min_by(F.struct(*first_columns), first_order).alias("first"),
        F.max_by(F.struct(*last_columns), last_order).alias("last"),
    )


def ordering(*columns: Column, nulls_last: bool = False) -> Column:
    """A struct to order by; NULL sorts lowest in a struct unless ``nulls_last`` flags it."""
    if not nulls_last:
        return F.struct(*columns)
    return F.struct(*[part for c in columns for part in (c.isNull(), c)])
