"""Version picks, incremental loads, upserts and history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.catalog.shared import LINES, plain
from orderloom.operators.asof import as_of_join
from orderloom.operators.dedup import first_and_last, keep_earliest, keep_latest, ordering
from orderloom.operators.history import buckets_for, scd2_as_of, scd2_current, scd2_run, scd2_schema, scd2_table
from orderloom.functions.times import from_micros, micros
from orderloom.operators.incremental import FLOOR, high_water, high_water_overall, increment, increment_by_store
from orderloom.operators.merge import merge_ranked, merge_upsert
from orderloom.session import cut_lineage, shared_folder
from orderloom.plans import marketplace as M
from orderloom.plans import storefront as S
from orderloom.sources.derived import marketplace_orders, storefront_orders, table
from orderloom.sources.folders import matching
from orderloom.sources.readers import read_footers
from orderloom.sources.sinks import append_increment, read_table
from orderloom.sources.versions import read as read_version
from orderloom.sources.versions import vacuum, write

LINE = ["l_orderkey", "l_linenumber"]
NEWEST = ["l_shipdate", "l_partkey", "l_suppkey"]
RUNS = ["1997-01-01", "1999-06-01", None]
EVENT_CUT = "2024-01-15 00:00:00"


def line_items_latest(spark: SparkSession, sf: str) -> DataFrame:
    return plain(keep_latest(table(spark, sf, "lineitem"), LINE, NEWEST))


def line_items_earliest(spark: SparkSession, sf: str) -> DataFrame:
    dearest = [F.col("l_extendedprice").desc_nulls_last(), F.col("l_partkey"), F.col("l_suppkey")]
    return plain(keep_earliest(table(spark, sf, "lineitem"), LINE, ["l_shipdate"], dearest))


def line_items_first_last(spark: SparkSession, sf: str) -> DataFrame:
    order = ordering(*[F.col(c) for c in NEWEST])
    pairs = first_and_last(
        table(spark, sf, "lineitem"), LINE, (["l_extendedprice", "l_shipdate"], order), (["l_linestatus", "l_shipdate"], order)
    )
    return plain(
        pairs.select(
            *LINE,
            F.col("first.l_extendedprice").alias("first_price"),
            F.col("first.l_shipdate").alias("first_date"),
            F.col("last.l_linestatus").alias("last_status"),
            F.col("last.l_shipdate").alias("last_date"),
        )
    )


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def _loaded_before(ts: str) -> Column:
    """Whether the target already has an event; clicks are new to it."""
    return (F.col(ts) < F.lit(EVENT_CUT).cast("timestamp_ntz")) & (F.col("event_type") != "click")


def _at_rest(events: DataFrame, name: str) -> str:
    """Events stored as a feed: a table per type, in order of load; the load time is a whole number."""
    folder = shared_folder(events.sparkSession, name)
    rows = events.withColumn("loaded", micros(F.col("ts"))).hint("rebalance", "event_type")
    rows.sortWithinPartitions("event_type", "loaded").write.partitionBy("event_type").parquet(folder)
    return folder


def _since_marks(spark: SparkSession, sf: str, **how) -> DataFrame:
    """What the target lacks of the events, by the marks in the footers of its files."""
    events = _events(spark, sf)
    feed = _at_rest(events, "feed")
    target = _at_rest(events.where(_loaded_before("ts")), "target")
    marks = cut_lineage(high_water(read_footers(spark, target), "event_type", "loaded"), "marks")
    stores = [(p.rsplit("=", 1)[1], spark.read.parquet(p)) for p in sorted(matching(spark, f"{feed}/event_type=*"))]
    return increment_by_store(stores, marks, "event_type", "loaded", **how).drop("loaded")


def increment_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_since_marks(spark, sf))


def increment_exclusive_floor(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_since_marks(spark, sf, inclusive=False, floor=int(FLOOR.replace(tzinfo=dt.UTC).timestamp()) * 1_000_000))


def increment_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The marks of all stores meet one table of them in a join."""
    events = _events(spark, sf)
    return plain(increment(events, high_water(events.where(_loaded_before("ts")), "event_type", "ts"), "event_type", "ts"))


def high_water_marks(spark: SparkSession, sf: str) -> DataFrame:
    marks = high_water(read_footers(spark, _at_rest(_events(spark, sf), "target")), "event_type", "loaded", "newest")
    return plain(marks.select("event_type", from_micros(F.col("newest")).alias("max_ts")))


def high_water_of_all(spark: SparkSession, sf: str) -> DataFrame:
    """One mark for the whole table, and for an empty one its floor."""
    events, floor = _events(spark, sf), -1
    marks = high_water_overall(read_footers(spark, _at_rest(events, "target")), "loaded", floor, "newest")
    none = high_water_overall(events.where("event_type = 'none'").withColumn("loaded", micros(F.col("ts"))), "loaded", floor, "floor")
    return plain(marks.join(none, on=marks.newest != none.floor).select(from_micros(F.col("newest")).alias("max_ts"), "floor"))


def merge_committed(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads into a committed table: the second widens a column and brings one, the third drops one; one in between breaks off."""
    events, path, keys = _events(spark, sf), shared_folder(spark, "committed"), ["user_id", "event_type"]
    newest = [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]
    before, after = _halves(events)
    write(spark, path, before.withColumn("event_id", F.col("event_id").cast("int")).drop("props"), keys, newest, buckets=8)
    broken = after.withColumn("value", F.when(F.col("event_id") >= 0, F.raise_error(F.lit("the feed broke off"))).otherwise(F.col("value")).cast("double"))
    try:
        write(spark, path, broken, keys, newest)
    except Exception as error:
        if "the feed broke off" not in str(error):
            raise
    write(spark, path, after, keys, newest, mode="ranked")
    write(spark, path, events.where("event_type = 'error'").drop("value"), keys, newest, mode="ranked", sync=True)
    vacuum(spark, path)
    return plain(read_version(spark, path))


def _halves(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An earlier load and a later one that sends the boundary day again."""
    cut = F.lit(EVENT_CUT).cast("timestamp_ntz")
    return events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut - F.expr("interval 1 day"))


def append_then_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads appended to a log, the boundary day in both; then the latest event per user."""
    log = shared_folder(spark, "log")
    events = _events(spark, sf)
    for load in _halves(events):
        append_increment(load, log, events.schema)
    rows = read_table(spark, log, events.schema)
    return plain(keep_latest(rows, ["user_id", "event_type"], ["ts", "event_id"]))


def _upserted(spark: SparkSession, sf: str, merge) -> DataFrame:
    before, after = _halves(_events(spark, sf))
    keys = ["user_id", "event_type"]
    newest = [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]
    target = keep_latest(before, keys, ["ts", "event_id"])
    return plain(merge(target, after, keys, newest))


def merge_upsert_events(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, merge_upsert)


def merge_ranked_events(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, merge_ranked)


def merge_first_version(spark: SparkSession, sf: str) -> DataFrame:
    """First event per user and type, loaded in two steps."""
    before, after = _halves(_events(spark, sf))
    keys = ["user_id", "event_type"]
    oldest = [F.col("ts").asc_nulls_last(), F.col("event_id").asc_nulls_last()]
    return plain(merge_ranked(keep_earliest(after, keys, ["ts", "event_id"]), before, keys, oldest))


def _buckets(spark: SparkSession, sf: str) -> int:
    """Buckets for a history of what the line items tell."""
    return buckets_for(spark, f"{sf}/lineitem.parquet")


def _history(spark: SparkSession, sf: str, columns: Sequence[str] = (*NEWEST, "l_extendedprice", "l_linestatus")) -> DataFrame:
    """History of the line items, of ``columns``, over three runs, each seeing what had shipped by then, the last one everything."""
    lineitem = table(spark, sf, "lineitem").select(*LINE, *NEWEST, "l_extendedprice", "l_linestatus")
    path, buckets = shared_folder(spark, "history"), _buckets(spark, sf)
    for number, run in enumerate(RUNS):
        seen = lineitem.where(F.col("l_shipdate") < F.lit(run).cast("timestamp_ntz")) if run else lineitem
        current = keep_latest(seen, LINE, NEWEST).select(*LINE, *columns)
        scd2_run(spark, path, number, current, LINE, "l_shipdate", buckets=buckets)
    return scd2_table(spark, path, scd2_schema(current.schema, "l_shipdate"))


def storefront_history(spark: SparkSession, sf: str) -> DataFrame:
    """History of staged order lines over three runs: the second lacks a store, the third brings older versions of some."""
    orders = storefront_orders(table(spark, sf, "lineitem"))
    lines = S.stage_order_lines(orders).select(*S.LINE_KEY, "quantity", *S.VERSION_ORDER)
    at, even = F.col("updated_at"), F.col("order_id").cast("bigint") % 2 == 0
    runs = [
        at < F.lit("1996-01-01").cast("timestamp_ntz"),
        (at < F.lit("1997-06-01").cast("timestamp_ntz")) & (F.col("brand") != "STORE_B"),
        ~even | (at < F.lit("1995-01-01").cast("timestamp_ntz")),
    ]
    path, schema, buckets = shared_folder(spark, "history"), None, _buckets(spark, sf)
    for number, seen in enumerate(runs):
        current = S.history_rows(lines.where(seen)).select("history_key", "quantity", "updated_at_utc")
        scd2_run(spark, path, number, current, ["history_key"], "updated_at_utc", buckets=buckets)
        schema = scd2_schema(current.schema, "updated_at_utc")
    return plain(scd2_table(spark, path, schema))


def append_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """A load without ``props``, then one that has it, appended under the first one's schema."""
    log, events = shared_folder(spark, "log"), _events(spark, sf)
    cut = F.lit(EVENT_CUT).cast("timestamp_ntz")
    before = events.where(F.col("ts") < cut).drop("props")
    append_increment(before, log)
    append_increment(events.where(F.col("ts") >= cut), log, before.schema)
    return plain(read_table(spark, log))


def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_history(spark, sf))


def scd2_current_rows(spark: SparkSession, sf: str) -> DataFrame:
    return plain(scd2_current(_history(spark, sf)))


def scd2_as_of_rows(spark: SparkSession, sf: str) -> DataFrame:
    at = F.lit(dt.datetime(1998, 7, 1).isoformat(sep=" ")).cast("timestamp_ntz")
    return plain(scd2_as_of(_history(spark, sf), at))


def as_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every order as it was when the order was placed."""
    columns = ["l_shipdate", "l_extendedprice", "l_linestatus"]
    history = _history(spark, sf, columns)
    lines = table(spark, sf, "lineitem").select(*LINE).distinct()
    facts = table(spark, sf, "orders").select("o_orderkey", "o_orderdate").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("o_orderkey")
    return plain(as_of_join(facts, history, LINE, "o_orderdate", columns, "was_"))


def marketplace_history(spark: SparkSession, sf: str) -> DataFrame:
    """History of marketplace lines over three runs."""
    lines = M.stage_lines(marketplace_orders(table(spark, sf, "lineitem")))
    return _line_history(spark, sf, lines, "update_time", ["order_status", "sale_price"])


def shipping_history(spark: SparkSession, sf: str) -> DataFrame:
    """History of storefront shipping lines over three runs."""
    staged = S.stage_shipping_lines(storefront_orders(table(spark, sf, "lineitem")))
    path, buckets = shared_folder(spark, "history"), _buckets(spark, sf)
    for number, run in enumerate(RUNS):
        seen = staged.where(F.col("updated_at") < F.lit(run).cast("timestamp_ntz")) if run else staged
        current = S.history_rows(seen, S.SHIPPING_KEY).select("history_key", "shipping_price", "updated_at_utc")
        scd2_run(spark, path, number, current, ["history_key"], "updated_at_utc", buckets=buckets)
    return plain(scd2_table(spark, path, scd2_schema(current.schema, "updated_at_utc")))


def _line_history(spark: SparkSession, sf: str, lines: DataFrame, at: str, tracked: list[str]) -> DataFrame:
    path, buckets = shared_folder(spark, "history"), _buckets(spark, sf)
    for number, run in enumerate(RUNS):
        seen = lines.where(F.col(at) < F.lit(run).cast("timestamp_ntz")) if run else lines
        current = M.history_rows(seen).select("history_key", *tracked, at)
        scd2_run(spark, path, number, current, ["history_key"], at, buckets=buckets)
    return plain(scd2_table(spark, path, scd2_schema(current.schema, at)))


QUERIES = {
    "line_items_latest": line_items_latest,
    "line_items_earliest": line_items_earliest,
    "line_items_first_last": line_items_first_last,
    "increment_inclusive": increment_inclusive,
    "increment_exclusive_floor": increment_exclusive_floor,
    "increment_joined": increment_joined,
    "high_water_marks": high_water_marks,
    "high_water_of_all": high_water_of_all,
    "merge_committed": merge_committed,
    "append_then_latest": append_then_latest,
    "append_new_column": append_new_column,
    "merge_upsert": merge_upsert_events,
    "merge_ranked": merge_ranked_events,
    "merge_first_version": merge_first_version,
    "scd2_history": scd2_history,
    "storefront_history": storefront_history,
    "scd2_current": scd2_current_rows,
    "scd2_as_of": scd2_as_of_rows,
    "as_of_orders": as_of_orders,
    "marketplace_history": marketplace_history,
    "shipping_history": shipping_history,
}

_LINEITEM = """l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, cast(l_shipdate as varchar) as l_shipdate"""
_EVENT = "event_id, cast(ts as varchar) as ts, user_id, event_type, value, props"
_MARKS = f"""
    with marks as (
        select event_type as t, max(ts) as mark from events
        where ts < timestamp '{EVENT_CUT}' and event_type <> 'click' group by 1
    )
"""
_LATEST_EVENT = f"""
    select {_EVENT} from events
    qualify row_number() over (partition by user_id, event_type order by events.ts desc, event_id desc) = 1
"""
# Each run sees the newest version shipped before it; a key gets a history row per distinct version seen.
_HISTORY = f"""
    with seen as (
        {' union all '.join(
            f'''(select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_linestatus,
                        {i} as run from lineitem {f"where l_shipdate < timestamp '{run}'" if run else ""}
                 qualify row_number() over (partition by l_orderkey, l_linenumber
                                            order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1)'''
            for i, run in enumerate(RUNS))}
    ),
    versions as (
        select * from seen qualify row_number() over (partition by l_orderkey, l_linenumber, l_shipdate order by run) = 1
    ),
    history as (
        select *, l_shipdate as valid_from,
               lead(l_shipdate) over (partition by l_orderkey, l_linenumber order by l_shipdate) as valid_to
        from versions
    )
    select l_orderkey, l_linenumber::bigint as l_linenumber, cast(l_shipdate as varchar) as l_shipdate, l_partkey,
           l_suppkey, l_extendedprice, l_linestatus, cast(valid_from as varchar) as valid_from,
           cast(valid_to as varchar) as valid_to
    from history
"""
# The newest version of a line in each run; it opens a row if it is newer than all that earlier runs showed.
_STORE_HISTORY = f"""
    with li as ({LINES}),
    lines as (
        select brand, order_id, line_id as line, l_quantity as quantity, l_shipdate, loaded_at, batch_id from li
        union all
        select brand, order_id, cast(l_linenumber + 100 as varchar), 0.0::double, l_shipdate, loaded_at, batch_id from li
    ),
    runs as (
        select *, 0 as run from lines where l_shipdate < timestamp '1996-01-01'
        union all
        select *, 1 from lines where l_shipdate < timestamp '1997-06-01' and brand <> 'STORE_B'
        union all
        select *, 2 from lines where order_id::bigint % 2 <> 0 or l_shipdate < timestamp '1995-01-01'
    ),
    seen as (
        select * from runs
        qualify row_number() over (partition by brand, order_id, line, run
                                   order by l_shipdate desc, loaded_at desc, batch_id desc) = 1
    ),
    ordered as (
        select *, max(l_shipdate) over (partition by brand, order_id, line order by run
                                        rows between unbounded preceding and 1 preceding) as before
        from seen
    ),
    opened as (select * from ordered where before is null or l_shipdate > before)
    select 'Storefront|' || brand || '|' || order_id || '|' || line || '|sale' as history_key, quantity,
           cast(l_shipdate as varchar) as updated_at_utc, cast(l_shipdate as varchar) as valid_from,
           cast(lead(l_shipdate) over (partition by brand, order_id, line order by run) as varchar) as valid_to
    from opened
"""

# Runs that see the rows updated by then; a key gets a history row per distinct time of its newest version.
_RUN_HISTORY = """
    with li as ({lines}),
    rows as ({rows}),
    seen as (
        {runs}
    ),
    versions as (select * from seen qualify row_number() over (partition by history_key, changed_at order by run) = 1)
    select history_key, {tracked}, cast(changed_at as varchar) as {at}, cast(changed_at as varchar) as valid_from,
           cast(lead(changed_at) over (partition by history_key order by changed_at) as varchar) as valid_to
    from versions
"""


def _run_history(rows: str, tracked: str, at: str, newest: str) -> str:
    runs = " union all ".join(
        f"""(select *, {i} as run from rows {f"where changed_at < timestamp '{run}'" if run else ""}
             qualify row_number() over (partition by history_key order by {newest}) = 1)"""
        for i, run in enumerate(RUNS)
    )
    return _RUN_HISTORY.format(lines=LINES, rows=rows, runs=runs, tracked=tracked, at=at)


ORACLES = {
    "as_of_orders": f"""
    with history as (select *, valid_from as f, valid_to as t from ({_HISTORY})),
    facts as (select distinct l.l_orderkey, l.l_linenumber, o.o_orderdate from lineitem l join orders o on o.o_orderkey = l.l_orderkey)
    select x.l_orderkey, x.l_linenumber::bigint as l_linenumber, cast(x.o_orderdate as varchar) as o_orderdate,
           h.l_shipdate as was_l_shipdate, h.l_extendedprice as was_l_extendedprice, h.l_linestatus as was_l_linestatus
    from facts x left join history h
      on h.l_orderkey = x.l_orderkey and h.l_linenumber = x.l_linenumber
     and h.f::timestamp <= x.o_orderdate and (h.t is null or x.o_orderdate < h.t::timestamp)
""",
    "marketplace_history": _run_history(
        """select brand || '|' || order_id || '|' || line_id as history_key, l_shipdate + interval 2 hour as changed_at, loaded_at, batch_id,
                  case when l_returnflag = 'A' and l_linestatus = 'F' then 'CANCELLED' else 'COMPLETED' end as order_status,
                  l_extendedprice * (1 - l_discount) as sale_price from li""",
        "order_status, sale_price", "update_time", "changed_at desc, loaded_at desc, batch_id desc",
    ),
    "shipping_history": _run_history(
        """select 'Storefront|' || brand || '|' || order_id || '|' || line_id || '|sale' as history_key, l_shipdate as changed_at, loaded_at, batch_id,
                  l_tax * 100 as shipping_price from li where l_returnflag = 'R'""",
        "shipping_price", "updated_at_utc", "changed_at desc, loaded_at desc, batch_id desc",
    ),
    "increment_joined": _MARKS + f" select {_EVENT} from events left join marks on event_type = t where mark is null or events.ts >= mark",
    "line_items_latest": f"""
    select {_LINEITEM} from lineitem
    qualify row_number() over (partition by l_orderkey, lineitem.l_linenumber
                               order by lineitem.l_shipdate desc, l_partkey desc, l_suppkey desc) = 1
""",
    "line_items_earliest": f"""
    select {_LINEITEM} from lineitem
    qualify row_number() over (partition by l_orderkey, lineitem.l_linenumber
                               order by lineitem.l_shipdate, l_extendedprice desc, l_partkey, l_suppkey) = 1
""",
    "line_items_first_last": """
    with ranked as (
        select *, row_number() over (partition by l_orderkey, l_linenumber
                                     order by l_shipdate, l_partkey, l_suppkey) as up,
               row_number() over (partition by l_orderkey, l_linenumber
                                  order by l_shipdate desc, l_partkey desc, l_suppkey desc) as down
        from lineitem
    )
    select a.l_orderkey, a.l_linenumber::bigint as l_linenumber, a.l_extendedprice as first_price,
           cast(a.l_shipdate as varchar) as first_date, b.l_linestatus as last_status,
           cast(b.l_shipdate as varchar) as last_date
    from ranked a join ranked b using (l_orderkey, l_linenumber) where a.up = 1 and b.down = 1
""",
    "increment_inclusive": _MARKS
    + f"""
    select {_EVENT} from events left join marks on event_type = t where mark is null or events.ts >= mark
""",
    "increment_exclusive_floor": _MARKS
    + f"""
    select {_EVENT} from events left join marks on event_type = t
    where events.ts > coalesce(mark, timestamp '1900-01-01')
""",
    "high_water_marks": "select event_type, cast(max(ts) as varchar) as max_ts from events group by event_type",
    "high_water_of_all": "select cast(max(ts) as varchar) as max_ts, -1::bigint as floor from events",
    # The whole table is loaded; ``props`` is missing in rows that only the first load had, ``value`` from the end.
    "merge_committed": f"""
    with latest as ({_LATEST_EVENT})
    select event_id, ts, user_id, event_type, case when ts >= cast(timestamp '{EVENT_CUT}' - interval 1 day as varchar) or event_type = 'error' then props end as props
    from latest
""",
    "append_then_latest": _LATEST_EVENT,
    "append_new_column": f"""
    select event_id, cast(ts as varchar) as ts, user_id, event_type, value,
           case when events.ts >= timestamp '{EVENT_CUT}' then props end as props
    from events
""",
    "merge_upsert": _LATEST_EVENT,
    "merge_ranked": _LATEST_EVENT,
    "merge_first_version": f"""
    select {_EVENT} from events
    qualify row_number() over (partition by user_id, event_type order by events.ts, event_id) = 1
""",
    "scd2_history": _HISTORY,
    "storefront_history": _STORE_HISTORY,
    "scd2_current": _HISTORY + " where history.valid_to is null",
    "scd2_as_of": _HISTORY
    + """ where history.valid_from <= timestamp '1998-07-01'
          and (history.valid_to is null or timestamp '1998-07-01' < history.valid_to)""",
}
