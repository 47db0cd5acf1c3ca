"""The streaming loads, run over the events table as it arrives in three loads; later loads hold late versions, too."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.catalog.shared import plain
from orderloom.operators.dedup import keep_latest
from orderloom.operators.history import scd2_schema
from orderloom.session import shared_folder
from orderloom.sources.derived import table
from orderloom.streaming import loads

KEYS = ["user_id", "event_type"]
BUCKETS = 8


LOADS = 3


def _arrive(spark: SparkSession, sf: str, folder: str, start: Callable[[DataFrame], StreamingQuery]) -> DataFrame:
    """Let the events arrive in loads by event id and run ``start`` to its end after each."""
    events, landing = table(spark, sf, "events"), f"{folder}/landing"
    for load in range(LOADS):
        events.where(F.col("event_id") % LOADS == load).write.mode("append").parquet(landing)
        start(loads.read_arrivals(spark, landing, events.schema)).awaitTermination()
    return events


def _newest() -> list:
    return [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]


def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "stream-append")
    events = _arrive(spark, sf, folder, lambda rows: loads.append_stream(rows, f"{folder}/log", f"{folder}/checkpoint"))
    log = spark.read.schema(events.schema).parquet(f"{folder}/log")
    return plain(keep_latest(log, KEYS, ["ts", "event_id"]))


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "stream-upsert")
    path, checkpoint = f"{folder}/current", f"{folder}/checkpoint"
    events = _arrive(spark, sf, folder, lambda rows: loads.upsert_stream(rows, path, checkpoint, KEYS, _newest(), BUCKETS))
    return plain(loads.current_rows(spark, path, events.schema))


def stream_history(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "stream-history")
    path, checkpoint = f"{folder}/history", f"{folder}/checkpoint"
    events = _arrive(spark, sf, folder, lambda rows: loads.history_stream(rows, path, checkpoint, KEYS, "ts", _newest(), BUCKETS))
    return plain(loads.current_rows(spark, path, scd2_schema(events.schema, "ts")))


#: Ends of the first two thirds of the events' month.
THIRDS = ["2024-01-11", "2024-01-21"]


def _guarded(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Loads in order of time, in which every fiftieth event comes one load late; the first load has no signups, so none of theirs is late."""
    folder, events = shared_folder(spark, "stream-guarded"), table(spark, sf, "events")
    path, landing = f"{folder}/current", f"{folder}/landing"
    third = sum((F.col("ts") >= F.lit(t).cast("timestamp_ntz")).cast("int") for t in THIRDS)
    late = F.when(F.col("event_id") % 50 == 0, 1).otherwise(0)
    load = F.greatest(F.least(third + late, F.lit(2)), F.when(F.col("event_type") == "signup", 1).otherwise(0))
    for number in range(LOADS):
        events.where(load == number).write.mode("append").parquet(landing)
        rows = loads.read_arrivals(spark, landing, events.schema)
        loads.guarded_upsert_stream(rows, path, f"{folder}/checkpoint", KEYS, _newest(), "event_type", "ts", buckets=BUCKETS).awaitTermination()
    return events, path


def stream_guarded(spark: SparkSession, sf: str) -> DataFrame:
    events, path = _guarded(spark, sf)
    return plain(loads.current_rows(spark, path, events.schema))


def stream_refused(spark: SparkSession, sf: str) -> DataFrame:
    """Refused rows per type and load."""
    events, path = _guarded(spark, sf)
    refused = loads.refused_rows(spark, path, events.schema)
    return plain(refused.groupBy("event_type", "batch").agg(F.count("*").alias("refused"), F.min("ts").alias("oldest")))


QUERIES = {"stream_guarded": stream_guarded, "stream_refused": stream_refused, "stream_append": stream_append, "stream_upsert": stream_upsert, "stream_history": stream_history}

_LATEST = """
    select event_id, cast(ts as varchar) as ts, user_id, event_type, value, props from events
    qualify row_number() over (partition by user_id, event_type order by events.ts desc, event_id desc) = 1
"""
# The newest event of each load opens a row if it is newer than those of all loads before.
_HISTORY = f"""
    with seen as (
        select *, event_id % {LOADS} as load from events
        qualify row_number() over (partition by user_id, event_type, event_id % {LOADS} order by ts desc, event_id desc) = 1
    ),
    ordered as (
        select *, max(ts) over (partition by user_id, event_type order by load
                                rows between unbounded preceding and 1 preceding) as before
        from seen
    ),
    opened as (select * from ordered where before is null or ts > before)
    select event_id, cast(opened.ts as varchar) as ts, user_id, event_type, value, props,
           cast(opened.ts as varchar) as valid_from,
           cast(lead(opened.ts) over (partition by user_id, event_type order by load) as varchar) as valid_to
    from opened
"""

_GUARDED = f"""
    with timed as (
        select *, (ts >= timestamp '{THIRDS[0]}')::int + (ts >= timestamp '{THIRDS[1]}')::int as third from events
    ),
    loaded as (
        select *, greatest(least(third + case when event_id % 50 = 0 then 1 else 0 end, 2), case when event_type = 'signup' then 1 else 0 end) as load
        from timed
    ),
    marked as (
        select e.*, (select max(m.ts) from loaded m where m.event_type = e.event_type and m.load < e.load) as mark from loaded e
    )
"""

ORACLES = {
    "stream_guarded": _GUARDED
    + """
    select event_id, cast(ts as varchar) as ts, user_id, event_type, value, props from marked where mark is null or marked.ts >= mark
    qualify row_number() over (partition by user_id, event_type order by marked.ts desc, event_id desc) = 1
""",
    "stream_refused": _GUARDED
    + """
    select event_type, load::bigint as batch, count(*) as refused, cast(min(marked.ts) as varchar) as oldest
    from marked where marked.ts < mark group by event_type, load
""",
    "stream_append": _LATEST,
    "stream_upsert": _LATEST,
    "stream_history": _HISTORY,
}
