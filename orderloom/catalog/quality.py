"""Ids, times, checks, reconciliation, scans and schema steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.catalog.shared import LINES, money, pacific, plain, store
from orderloom.functions.ids import normalize_id
from orderloom.functions.money import MONEY, to_money
from orderloom.functions.semi import object_entries
from orderloom.functions.times import as_utc, from_millis, micros, pacific_date, to_millis, to_pacific
from orderloom.operators.connectors import reconcile, reconcile_summary
from orderloom.operators.quality import (
    check_id_consistency,
    check_id_format,
    check_unique,
    source_freshness,
)
from orderloom.plans import storefront as S
from orderloom.sources import derived as D
from orderloom.sources.readers import read_stores, with_brand_name
from orderloom.sources.registry import StoreSource
from orderloom.sources.sinks import conform


CUT_OVER = "1998-01-01"


def id_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys in four spellings: plain, decimal, exponent, and not a number."""
    key = F.col("o_orderkey").cast("string")
    spelled = {
        "id_plain": key,
        "id_decimal": F.concat(key, F.lit(".000000000")),
        "id_exponent": F.concat(key, F.lit("0E-1")),
        "id_text": F.concat(F.lit("x"), key),
    }
    return D.table(spark, sf, "orders").select(
        "o_orderkey", *[normalize_id(c).alias(n) for n, c in spelled.items()]
    )


def id_format_check(spark: SparkSession, sf: str) -> DataFrame:
    """Raw and staged ids that are not integer-like, counted; staging leaves none."""
    raw = D.storefront_orders(D.table(spark, sf, "lineitem"))
    bad = check_id_format(
        [
            ("raw_orders", raw, "id"),
            ("staged_lines", S.stage_order_lines(raw), "line_item_id"),
            ("staged_shipping", S.stage_shipping_lines(raw), "shipping_line_id"),
        ]
    )
    return bad.groupBy("model_name", "id_field").agg(
        F.count("*").alias("violations"), F.min("id_value").alias("example")
    )


def id_consistency_check(spark: SparkSession, sf: str) -> DataFrame:
    """Line numbers that arrive as ``5`` in one version and ``5.000000000`` in another."""
    text = F.col("l_linenumber").cast("string")
    rows = D.table(spark, sf, "lineitem").select(
        D.store_of("l_orderkey").alias("brand"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(F.col("l_linestatus") == "F", F.concat(text, F.lit(".000000000")))
        .otherwise(text)
        .alias("raw_id"),
    )
    found = check_id_consistency([("lines", rows, "raw_id")], ["brand", "order_id"])
    return plain(found.drop("error_message"))


def id_consistency_since(spark: SparkSession, sf: str) -> DataFrame:
    """The same among rows shipped after a cut-over."""
    text = F.col("l_linenumber").cast("string")
    rows = D.table(spark, sf, "lineitem").select(
        D.store_of("l_orderkey").alias("brand"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(F.col("l_linestatus") == "F", F.concat(text, F.lit(".000000000"))).otherwise(text).alias("raw_id"),
        "l_shipdate",
    )
    since = F.col("l_shipdate") >= F.lit(CUT_OVER).cast("timestamp_ntz")
    return plain(check_id_consistency([("lines", rows, "raw_id")], ["brand", "order_id"], since).drop("error_message"))


def zoned_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times that arrive as instants: UTC wall clocks, whatever the session's zone."""
    events = D.table(spark, sf, "events").select("event_id", F.timestamp_micros(micros(F.col("ts"))).alias("at"))
    return plain(as_utc(events, "at").select("event_id", "at", to_pacific(F.col("at")).alias("at_pacific")))


def unique_check(spark: SparkSession, sf: str) -> DataFrame:
    found = check_unique(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "Duplicate line item.")
    return plain(found)


def mart_unique_check(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that occur twice in the current line items: those of one store, whose mart rows were appended a second time."""
    lineitem = D.table(spark, sf, "lineitem")
    legacy, replacement = (S.stage_order_lines(D.storefront_orders(lineitem, native)) for native in (False, True))
    mart = S.storefront_line_items(legacy, replacement, migrated=D.MOVED).select(*S.LINE_KEY)
    return plain(check_unique(mart.unionByName(mart.where("brand = 'STORE_B'")), S.LINE_KEY, "Duplicate line item."))


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return plain(source_freshness(D.table(spark, sf, "events"), "ts", None, now))


def freshness_epoch(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return plain(
        source_freshness(D.marketplace_orders(D.table(spark, sf, "lineitem")), "batch_runtime", "ms", now)
    )


def tz_pacific_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Events per Pacific day, their times sent through epoch milliseconds."""
    at = from_millis(to_millis(F.col("ts")))
    daily = D.table(spark, sf, "events").groupBy(pacific_date(at).alias("day_pt"), "event_type").agg(
        F.count("*").alias("events"), F.sum(to_money(F.col("value"))).cast(MONEY).alias("value")
    )
    return plain(daily)


def _two_copies(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders from two connectors; the new one lacks urgent open orders and rounds old totals."""
    orders = D.table(spark, sf, "orders")
    total = F.col("o_totalprice")
    keyed = [D.store_of("o_orderkey").alias("brand"), F.col("o_orderkey").cast("string").alias("order_id")]
    missing = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    rounded = F.when(F.col("o_orderstatus") == "P", F.floor(total).cast("double")).otherwise(total)
    old = orders.select(*keyed, to_money(total).alias("total"))
    new = orders.where(~missing).select(*keyed, to_money(rounded).alias("total"))
    return old, new


def reconcile_connectors(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reconcile(*_two_copies(spark, sf), ["brand", "order_id"], ["total"]))


def reconcile_totals(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reconcile_summary(reconcile(*_two_copies(spark, sf), ["brand", "order_id"], ["total"])))


def explode_object(spark: SparkSession, sf: str) -> DataFrame:
    entries = object_entries(D.table(spark, sf, "events").select("event_id", "props"), "props")
    return entries.select("event_id", "key", F.try_variant_get("value", "$", "string").alias("value"))


def store_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Six per-store tables stacked and tagged, with the stores' names."""
    sources = [StoreSource(s.lower(), s) for s in D.STORES]

    def read(session: SparkSession, location: str) -> DataFrame:
        return D.table(session, sf, "orders").where(D.store_of("o_orderkey") == location)

    rows = with_brand_name(read_stores(spark, sources, D.STOREFRONT, read))
    return plain(rows.select("source_platform", "brand", "brand_full", "o_orderkey", "o_orderdate"))


def schema_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in a target schema that lacks two columns, adds one and widens another."""
    target = T.StructType.fromDDL("o_orderkey decimal(38,0), o_totalprice double, o_orderstatus string, o_note string")
    return plain(conform(D.table(spark, sf, "orders"), target))


QUERIES = {
    "id_consistency_since": id_consistency_since,
    "zoned_times": zoned_times,
    "id_normalize": id_normalize,
    "id_format_check": id_format_check,
    "id_consistency_check": id_consistency_check,
    "unique_check": unique_check,
    "mart_unique_check": mart_unique_check,
    "freshness": freshness,
    "freshness_epoch": freshness_epoch,
    "tz_pacific_daily": tz_pacific_daily,
    "reconcile_connectors": reconcile_connectors,
    "reconcile_totals": reconcile_totals,
    "explode_object": explode_object,
    "store_scan": store_scan,
    "schema_sync": schema_sync,
}

_NOW = "timestamp '2024-02-01'"
_COPIES = f"""
    with both_sides as (
        select {store('o_orderkey')} as brand, cast(o_orderkey as varchar) as order_id,
               {money('o_totalprice')} as old_total,
               {money("case when o_orderstatus = 'P' then floor(o_totalprice) else o_totalprice end")} as new_total,
               o_orderpriority = '1-URGENT' and o_orderstatus = 'O' as missing
        from orders
    ),
    report as (
        select brand, order_id, 1::bigint as rows_old, old_total::double as total_old,
               case when missing then 0 else 1 end::bigint as rows_new,
               case when not missing then new_total::double end as total_new,
               case when missing then 'only_old' when old_total = new_total then 'same' else 'differs' end as status
        from both_sides
    )
"""

ORACLES = {
    "id_consistency_since": f"""
    with li as ({LINES}),
    raw as (
        select brand, order_id, line_id, case when l_linestatus = 'F' then line_id || '.000000000' else line_id end as raw_id
        from li where l_shipdate >= timestamp '{CUT_OVER}'
    )
    select 'lines' as model_name, brand, order_id, line_id as normalized_id, count(distinct raw_id) as distinct_formats,
           string_agg(distinct raw_id, ', ' order by raw_id) as format_examples
    from raw group by brand, order_id, line_id having count(distinct raw_id) > 1
""",
    "zoned_times": f"select event_id, cast(ts as varchar) as at, cast({pacific('ts')} as varchar) as at_pacific from events",
    "id_normalize": """
    select o_orderkey, cast(o_orderkey as varchar) as id_plain, cast(o_orderkey as varchar) as id_decimal,
           cast(o_orderkey as varchar) as id_exponent, null::varchar as id_text
    from orders
""",
    "id_format_check": """
    select 'raw_orders' as model_name, 'id' as id_field, count(*) as violations,
           min(l_orderkey || '.000000000') as example
    from lineitem where l_orderkey % 2 = 1 having count(*) > 0
""",
    "id_consistency_check": f"""
    with li as ({LINES}),
    raw as (
        select brand, order_id, line_id, case when l_linestatus = 'F' then line_id || '.000000000' else line_id end as raw_id
        from li
    )
    select 'lines' as model_name, brand, order_id, line_id as normalized_id, count(distinct raw_id) as distinct_formats,
           string_agg(distinct raw_id, ', ' order by raw_id) as format_examples
    from raw group by brand, order_id, line_id having count(distinct raw_id) > 1
""",
    "unique_check": """
    select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as row_count,
           'Duplicate line item.' as error_message
    from lineitem group by l_orderkey, lineitem.l_linenumber having count(*) > 1
""",
    # Every line is a sale of its own and brings a gift line.
    "mart_unique_check": f"""
    with li as ({LINES}),
    lines as (select order_id, line_id, l_returnflag, l_shipdate, loaded_at, batch_id from li where brand = 'STORE_B'),
    newest as (
        select * from (
            select order_id, line_id as line_item_id, l_returnflag, l_shipdate, loaded_at, batch_id from lines
            union all
            select order_id, cast(line_id::int + 100 as varchar), l_returnflag, l_shipdate, loaded_at, batch_id from lines
        )
        where l_returnflag <> 'A'
        qualify row_number() over (partition by order_id, line_item_id order by l_shipdate desc, loaded_at desc, batch_id desc) = 1
    )
    select 'Storefront' as source_platform, 'STORE_B' as brand, order_id, line_item_id, 'sale' as row_type,
           2::bigint as row_count, 'Duplicate line item.' as error_message
    from newest
""",
    "freshness": f"""
    select cast(max(ts) as varchar) as max_loaded_at,
           epoch({_NOW})::bigint - floor(epoch(max(ts)))::bigint as lag_seconds
    from events
""",
    "freshness_epoch": f"""
    with li as ({LINES})
    select cast(max(loaded_at) as varchar) as max_loaded_at,
           epoch({_NOW})::bigint - floor(epoch(max(loaded_at)))::bigint as lag_seconds
    from li
""",
    "tz_pacific_daily": f"""
    select cast({pacific("date_trunc('second', ts)")}::date as varchar) as day_pt, event_type, count(*) as events,
           sum({money('value')})::double as value
    from events group by 1, 2
""",
    "reconcile_connectors": _COPIES + " select * from report",
    "reconcile_totals": _COPIES
    + """
    select status, count(*) as keys, sum(rows_old)::bigint as rows_old, sum(rows_new)::bigint as rows_new
    from report group by status
""",
    "explode_object": """
    select event_id, 'k' as key, json_extract_string(props, '$.k') as value from events
""",
    "store_scan": f"""
    select 'Storefront' as source_platform, {store('o_orderkey')} as brand,
           'Store ' || right({store('o_orderkey')}, 1) as brand_full, o_orderkey,
           cast(o_orderdate as varchar) as o_orderdate
    from orders
""",
    "schema_sync": """
    select cast(o_orderkey as varchar) as o_orderkey, o_totalprice, o_orderstatus, null::varchar as o_note from orders
""",
}
