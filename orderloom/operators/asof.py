"""Facts with the version of their key that was valid at each fact's own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderloom.functions.times import micros
from orderloom.operators.history import FROM, TO

_DAY = 86_400_000_000


def as_of_join(
    facts: DataFrame, history: DataFrame, key: Sequence[str], at: str, columns: Sequence[str], prefix: str = "", days: int = 30
) -> DataFrame:
    """``facts`` with ``columns`` of the history row of their key that is valid at ``at``, NULL where none is.

    A row is valid from ``valid_from``, inclusive, to ``valid_to``, exclusive or open; keys match NULL-safely; facts without a time find nothing. Of history
    rows of one key that begin together one counts: the one that is open, or else ends last. No fact is lost or doubled.

    Facts and history are sorted together by key and time, and each fact takes the last row before it: one pass, no range join. To split a
    key that holds much of the data, time is cut into slices of ``days``; a slice begins with the last row that an earlier slice left, found
    from one row per key and slice. Choose ``days`` so that the facts of one key and slice fit a task.
    """
    taken = {prefix + c for c in columns} & set(facts.columns)
    if taken:
        raise ValueError(f"facts have columns {sorted(taken)}; choose a prefix")
    keys = [F.col(k).alias(f"k{i}") for i, k in enumerate(key)]
    names = [f"k{i}" for i in range(len(key))]
    # What a fact shares with every row of the join, its key and its time, is shuffled once.
    shared = {k: n for k, n in zip(key, names, strict=True) if k in facts.columns and facts.schema[k].dataType == history.schema[k].dataType}
    if at in facts.columns and facts.schema[at].dataType == history.schema[FROM].dataType:
        shared[at] = "time"
    own = [F.col(f"`{c}`") for c in facts.columns if c not in shared]
    fact = F.struct(*(own or [F.lit(True).alias("fact")]))
    row = F.struct(F.col(TO).alias("end"), F.struct(*columns).alias("row"))
    left = facts.select(*keys, _slice(F.col(at), days).alias("slice"), F.col(at).alias("time"), fact.alias("fact"))
    right = history.select(*keys, _slice(F.col(FROM), days).alias("slice"), F.col(FROM).alias("begin"), row.alias("version"))

    # At the begin of a slice with facts: the last version of the slices before it.
    asked = left.where("slice is not null").select(*names, "slice").distinct().withColumns({"version": _none(right.schema["version"].dataType), "asked": F.lit(True)})
    latest = F.max_by("version", F.struct("begin", F.col("version.end").isNull(), F.col("version.end")))
    last = right.groupBy(*names, "slice").agg(latest.alias("version")).withColumn("asked", F.lit(False))
    before = Window.partitionBy(*names).orderBy("slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = asked.unionByName(last).withColumn("version", F.last("version", ignorenulls=True).over(before)).where("asked and version is not null")

    none = _none(left.schema["fact"].dataType)
    versions = carried.drop("asked").withColumn("time", F.lit(None).cast(left.schema["time"].dataType))
    versions = versions.unionByName(right.withColumnRenamed("begin", "time"))
    both = left.withColumn("version", _none(right.schema["version"].dataType)).unionByName(versions.withColumn("fact", none))
    order = [F.col("time").asc_nulls_first(), F.col("fact").isNotNull(), F.col("version.end").asc_nulls_last()]
    upto = Window.partitionBy(*names, "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("version", F.last("version", ignorenulls=True).over(upto)).where("fact is not null")
    valid = F.col("time").isNotNull() & (F.col("version.end").isNull() | (F.col("time") < F.col("version.end")))
    kept = [F.when(valid, F.col("version.row").getField(c)).alias(prefix + c) for c in columns]
    return found.select(*[(F.col(shared[c]) if c in shared else F.col("fact").getField(c)).alias(c) for c in facts.columns], *kept)


def _slice(at: Column, days: int) -> Column:
    # Floor, so that times before 1970 fall into the slice they belong to.
    return F.floor(micros(at.cast("timestamp_ntz")).cast("double") / (days * _DAY))


def _none(kind: T.DataType) -> Column:
    return F.lit(None).cast(kind)
