"""Storefront line items, shipping lines, attributes, refunds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.catalog.shared import LINES, MOVED, money, pacific, plain
from orderloom.functions.ids import normalize_id
from orderloom.functions.semi import explode_array, parse_payloads
from orderloom.functions.semi import rejected_payloads as rejected
from orderloom.operators.attributes import MAP, attribute_columns
from orderloom.operators.connectors import union_connectors
from orderloom.operators.quality import check_refund_overlap
from orderloom.plans import marketplace as M
from orderloom.plans import refunds as R
from orderloom.plans import storefront as S
from orderloom.plans.columns import IDENTIFYING
from orderloom.session import shared_folder
from orderloom.sources import derived as D

_STAGED = [
    "brand", "order_id", "line_item_id", "product_sku", "product_title", "quantity", "product_price",
    "line_item_discount_total", "line_item_discount_per_unit", "order_name_number", "updated_at",
    "processed_at_pst", "row_type",
]


_SHIPPING = [
    "brand", "brand_full", "order_id", "line_item_id", "order_line_key", "product_key",
    "purchase_date", "purchase_date_pst", "last_updated_date", "currency", "shipping_price_total",
    "shipping_promotion_discount_total", "status",
]


def _lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "lineitem")


def _legacy(spark: SparkSession, sf: str) -> DataFrame:
    return D.storefront_orders(_lineitem(spark, sf))


def _replacement(spark: SparkSession, sf: str) -> DataFrame:
    """The replacement connector holds all stores, moved or not."""
    return D.storefront_orders(_lineitem(spark, sf), native=True)


def explode_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    return plain(S.stage_order_lines(_legacy(spark, sf)).select(*_STAGED))


def explode_native_lines(spark: SparkSession, sf: str) -> DataFrame:
    return plain(S.stage_order_lines(D.storefront_orders(_lineitem(spark, sf), native=True)).select(*_STAGED))


def rejected_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose line payload does not parse: in every seventh it is cut off, in every eleventh a field comes twice."""
    order, text = F.col("id").cast("string"), F.col("line_items")
    orders = _legacy(spark, sf).withColumn("order_id", normalize_id(order))
    number = F.col("order_id").cast("bigint")
    twice = F.concat(F.lit('[{"id":1,'), F.expr("substring(line_items, 3)"))
    cut = F.expr("substring(line_items, 1, length(line_items) - 2)")
    damaged = orders.withColumn("line_items", F.when(number % 7 == 0, cut).when(number % 11 == 0, twice).otherwise(text))
    return plain(rejected(damaged, "line_items").select("brand", "order_id", "updated_at"))


def both_connectors_refunds(spark: SparkSession, sf: str) -> DataFrame:
    """Refunds of stores that both connectors hold, moved or not: each counts once."""
    lineitem = _lineitem(spark, sf)
    known = R.known_orders(lineitem.select(D.store_of("l_orderkey").alias("brand"), F.col("l_orderkey").cast("string").alias("order_id")))
    out = R.canonical_refunds(
        R.refund_records(D.storefront_refunds(lineitem)), R.refund_records(D.storefront_refunds(lineitem, native=True)), known, D.MOVED
    )
    return out.select("brand", "refund_record_id", "refund_key", "refund_amount")


def line_discounts(spark: SparkSession, sf: str) -> DataFrame:
    return S.line_discounts(S.stage_order_lines(_legacy(spark, sf)))


def attributes_map(spark: SparkSession, sf: str) -> DataFrame:
    mapped = S.order_attributes(_legacy(spark, sf))
    return mapped.select(
        "brand", "order_id", *attribute_columns(), F.size(MAP).cast("bigint").alias("attributes")
    )


def shipping_lines(spark: SparkSession, sf: str) -> DataFrame:
    staged = S.stage_shipping_lines(_legacy(spark, sf))
    return plain(
        staged.select(
            "brand", "order_id", "shipping_line_id", "shipping_title", "shipping_price", "shipping_code",
            "is_removed", "shipping_discount", "order_name", "event_date",
        )
    )


def shipping_mart(spark: SparkSession, sf: str) -> DataFrame:
    mart = S.storefront_shipping(
        S.stage_shipping_lines(_legacy(spark, sf)),
        S.stage_shipping_lines(_replacement(spark, sf)),
        migrated=D.MOVED,
    )
    return plain(mart.select(*_SHIPPING))


def connector_union(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["brand", "order_id", "line_item_id", "quantity", "product_price", "batch_id"]
    legacy = S.stage_order_lines(_legacy(spark, sf)).select(*columns)
    replacement = S.stage_order_lines(_replacement(spark, sf))
    return union_connectors(legacy, replacement, D.MOVED)


def storefront_mart(spark: SparkSession, sf: str) -> DataFrame:
    legacy, replacement = _legacy(spark, sf), _replacement(spark, sf)
    kept = legacy.where(~F.col("brand").isin(*D.MOVED))
    # Each store's attributes come from the connector it is on.
    attributes = S.order_attributes(kept).unionByName(S.order_attributes(replacement.where(F.col("brand").isin(*D.MOVED))))
    mart = S.storefront_line_items(
        S.stage_order_lines(legacy), S.stage_order_lines(replacement), attributes, migrated=D.MOVED
    )
    return plain(mart.drop(MAP, "tags"))


def refund_records(spark: SparkSession, sf: str) -> DataFrame:
    return _refund_columns(R.refund_records(D.storefront_refunds(_lineitem(spark, sf)), strict=True))


def refund_records_native(spark: SparkSession, sf: str) -> DataFrame:
    return _refund_columns(R.refund_records(D.storefront_refunds(_lineitem(spark, sf), native=True)))


def _refund_columns(records: DataFrame) -> DataFrame:
    names = ["source_platform", "brand", "order_id", "refund_record_id", "created_at", *R.RECORD]
    return plain(records.select(*names))


def refunds_canonical(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = _lineitem(spark, sf)
    replacement = D.storefront_refunds(lineitem, native=True)
    feeds = [S.orders_with_lines(_legacy(spark, sf)), S.orders_with_lines(_replacement(spark, sf))]
    known = R.known_orders(
        *[f.where("source_name != 'marketplace'").select("brand", normalize_id(F.col("id")).alias("order_id")) for f in feeds]
    )
    out = R.canonical_refunds(
        R.refund_records(D.storefront_refunds(lineitem)), R.refund_records(replacement), known, D.MOVED
    )
    return plain(
        out.select(
            "brand", "brand_full", "order_id", "refund_record_id", "refund_line_item_id", "refund_key",
            "product_key", "record_type", "rli_product_sku", "rsl_shipping_title", "currency",
            "refund_amount", "refund_amount_raw", "shipping_refund_amount", "rli_product_quantity",
            "refund_date", "refund_date_pt", "refund_date_utc",
        )
    )


def refund_overlap_check(spark: SparkSession, sf: str) -> DataFrame:
    return plain(check_refund_overlap(R.refund_records(D.storefront_refunds(_lineitem(spark, sf)))))


def shipping_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with each of their shipping lines, or with none."""
    rows, line = explode_array(_legacy(spark, sf), "shipping_lines", outer=True)
    return plain(rows.select("brand", normalize_id(F.col("id")).alias("order_id"), "updated_at", line.get("$.title", "string").alias("title"), F.col("element_pos").cast("bigint").alias("at")))


def attributes_default(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute maps of orders of which some have no notes, an empty list, or text that is no list: their map is empty, not missing."""
    number = normalize_id(F.col("id")).cast("bigint")
    notes = F.when(number % 5 == 1, F.lit(None)).when(number % 5 == 2, "[]").when(number % 5 == 3, "{").otherwise(F.col("note_attributes"))
    mapped = S.order_attributes(_legacy(spark, sf).withColumn("note_attributes", notes.cast("string")))
    return mapped.select("brand", "order_id", F.size(MAP).cast("bigint").alias("attributes"), F.col(MAP).isNull().alias("missing"))


def discount_text(spark: SparkSession, sf: str) -> DataFrame:
    """The allocations of staged lines, kept whole as JSON text."""
    lines = S.stage_order_lines(_legacy(spark, sf))
    text = F.col("discount_allocations")
    kinds = [F.get_json_object(text, f"$[{i}].amount").cast("double").alias(f"amount_{i}") for i in range(2)]
    return plain(lines.select("brand", "order_id", "line_item_id", "updated_at", "batch_id", F.json_array_length(text).cast("bigint").alias("allocations"), *kinds))


def null_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads that begin with a JSON null, and prices that are one: a line without an id, and a NULL price beside its neighbours' values."""
    first = F.concat(F.lit("[null,"), F.expr("substring(line_items, 2)"))
    priced = F.regexp_replace(first, '"price":"0"', '"price":null')
    lines = S.stage_order_lines(_legacy(spark, sf).withColumn("line_items", priced))
    counts = [F.count("*").alias("lines"), F.count("line_item_id").alias("with_id"), F.count("product_price").alias("with_price"), F.sum("product_price").cast("decimal(38,2)").alias("price")]
    return plain(lines.groupBy("brand", "element_pos").agg(*counts))


def personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Identifying columns of every staged feed: none by default, and the one that is asked for by name."""
    lineitem, orders = _lineitem(spark, sf), D.table(spark, sf, "orders")
    raw = D.marketplace_returns(orders)
    made = {
        "order_lines": S.stage_order_lines(_legacy(spark, sf)),
        "refunds": R.refund_records(D.storefront_refunds(lineitem)),
        "marketplace_lines": M.stage_lines(D.marketplace_orders(lineitem)),
        "returns": M.returns(raw),
        "returns_asked": M.returns(raw, allow=["return_reason_text"]),
    }
    shown = []
    for feed, rows in made.items():
        known = [c for c in rows.columns if c in IDENTIFYING]
        cells = sum((F.count(c) for c in known), F.lit(0))
        shown.append(rows.agg(F.lit(feed).alias("feed"), F.lit(",".join(known)).alias("columns"), cells.cast("bigint").alias("cells")))
    return reduce(DataFrame.unionByName, shown)


def _stored(spark: SparkSession, orders: DataFrame, name: str) -> DataFrame:
    """A feed stored with its payloads parsed."""
    path = shared_folder(spark, name)
    parse_payloads(orders, ["line_items", "shipping_lines", "note_attributes"]).write.option("compression", "zstd").partitionBy("brand").parquet(path)
    return spark.read.parquet(path)


def parsed_once_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The line-item mart over stored feeds whose payloads were parsed when they arrived; lines and notes read the same VARIANTs."""
    legacy, replacement = _stored(spark, _legacy(spark, sf), "legacy"), _replacement(spark, sf)
    kept = legacy.where(~F.col("brand").isin(*D.MOVED))
    attributes = S.order_attributes(kept).unionByName(S.order_attributes(replacement.where(F.col("brand").isin(*D.MOVED))))
    mart = S.storefront_line_items(S.stage_order_lines(legacy), S.stage_order_lines(replacement), attributes, migrated=D.MOVED)
    return plain(mart.drop(MAP, "tags"))


def parsed_once_shipping(spark: SparkSession, sf: str) -> DataFrame:
    stored = _stored(spark, _legacy(spark, sf), "legacy")
    mart = S.storefront_shipping(S.stage_shipping_lines(stored), S.stage_shipping_lines(_replacement(spark, sf)), migrated=D.MOVED)
    return plain(mart.select(*_SHIPPING))


def parsed_once_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose line payload was cut off: known from the stored feed, without parsing it again."""
    number = normalize_id(F.col("id").cast("string")).cast("bigint")
    cut = F.expr("substring(line_items, 1, length(line_items) - 2)")
    stored = _stored(spark, _legacy(spark, sf).withColumn("line_items", F.when(number % 7 == 0, cut).otherwise(F.col("line_items"))), "legacy")
    return plain(rejected(stored, "line_items").select("brand", normalize_id(F.col("id")).alias("order_id"), "updated_at"))


QUERIES = {
    "parsed_once_mart": parsed_once_mart,
    "parsed_once_shipping": parsed_once_shipping,
    "parsed_once_rejected": parsed_once_rejected,
    "shipping_outer": shipping_outer,
    "attributes_default": attributes_default,
    "discount_text": discount_text,
    "null_elements": null_elements,
    "personal_data": personal_data,
    "rejected_payloads": rejected_payloads,
    "both_connectors_refunds": both_connectors_refunds,
    "explode_json_lines": explode_json_lines,
    "explode_native_lines": explode_native_lines,
    "line_discounts": line_discounts,
    "attributes_map": attributes_map,
    "shipping_lines": shipping_lines,
    "shipping_mart": shipping_mart,
    "connector_union": connector_union,
    "storefront_mart": storefront_mart,
    "refund_records": refund_records,
    "refund_records_native": refund_records_native,
    "refunds_canonical": refunds_canonical,
    "refund_overlap_check": refund_overlap_check,
}

_EXPLODED = f"""
    with li as ({LINES}),
    exploded as (
        select *, line_id as line_item_id, case when l_returnflag = 'N' then '' else sku end as product_sku,
               'Part ' || l_partkey as product_title, 'Item ' || l_partkey as item_name, l_quantity as quantity,
               l_extendedprice as product_price,
               0.0::double + l_extendedprice * l_discount + l_tax as line_item_discount_total
        from li
        union all
        select *, cast(l_linenumber + 100 as varchar), null, 'Gift', 'Gift', 0.0::double, 0.0::double, null
        from li
    ),
    staged as (
        select *, coalesce(line_item_discount_total, 0.0::double) / nullif(quantity, 0) as line_item_discount_per_unit
        from exploded
    )
"""
_STAGED_SQL = f"""
    select brand, order_id, line_item_id, product_sku, product_title, quantity, product_price,
           line_item_discount_total, line_item_discount_per_unit, order_id as order_name_number,
           cast(l_shipdate as varchar) as updated_at, cast({pacific('l_shipdate')} as varchar) as processed_at_pst,
           'sale' as row_type
    from staged
"""
_LATEST_LINE = """
    qualify row_number() over (partition by brand, order_id, line_item_id
                               order by l_shipdate desc, loaded_at desc, batch_id desc) = 1
"""
_LATEST_ORDER = """
    select brand, order_id, l_linestatus as order_type, 'line-' || l_linenumber as utm_source,
           cast(l_partkey as varchar) as client_order_id, cast(l_suppkey as varchar) as card_last4
    from li
    qualify row_number() over (partition by brand, order_id order by loaded_at desc, batch_id desc) = 1
"""
_REFUNDED = f"""
    with li as ({LINES}),
    latest as (
        select *, cast(l_orderkey * 10 + l_linenumber as varchar) as refund_id,
               l_tax * 100 as cost, l_linestatus = 'F' as shipped
        from li where l_returnflag = 'R'
    ),
    records as (
        select brand, order_id, refund_id, l_shipdate, loaded_at, batch_id, 'refund_line_item' as record_type,
               line_id as refund_line_item_id, null::double as a_amount, null as a_kind, null as a_reason,
               null as a_linked_refund_id, null::double as a_tax_amount, null as a_currency_code,
               'Part ' || l_partkey as title, sku, l_extendedprice as price, l_quantity::int as quantity,
               'return' as restock, l_extendedprice as subtotal, l_tax as tax, 'usd ' as currency,
               null as rsl_title, null::double as rsl_price, null as rsl_source, null as rsl_currency
        from latest
        union all
        select brand, order_id, refund_id, l_shipdate, loaded_at, batch_id, 'adjustment',
               cast(l_linenumber + 500 as varchar), 0.0::double - case when shipped then cost else l_discount end,
               case when shipped then 'shipping_refund' else 'refund_discrepancy' end, 'refund', refund_id,
               0.0::double, 'usd ', null, null, null, null, null, null, null, null, null, null, null, null
        from latest
        {{shipping}}
    ),
    picked as (
        select * from records
        qualify row_number() over (partition by brand, refund_id, refund_line_item_id, record_type
                                   order by loaded_at desc, {{tie}} l_shipdate desc) = 1
    )
"""
_RSL = """
        union all
        select brand, order_id, refund_id, l_shipdate, loaded_at, batch_id, 'refund_shipping_line',
               cast(l_linenumber + 900 as varchar), null, null, null, null, null, null, null, null, null, null,
               null, null, null, null, 'Standard', cost, 'storefront', 'usd '
        from latest where shipped
"""
_LEGACY_REFUNDS = _REFUNDED.format(shipping=_RSL, tie="batch_id desc,")
_RECORD_COLUMNS = """
    select 'Storefront' as source_platform, brand, order_id, refund_id as refund_record_id,
           cast(l_shipdate as varchar) as created_at, record_type, refund_line_item_id, a_amount, a_kind, a_reason,
           a_linked_refund_id, a_tax_amount, a_currency_code, title as rli_product_title, sku as rli_product_sku,
           price as rli_product_price, quantity::bigint as rli_product_quantity, restock as rli_restock_type,
           subtotal as rli_refund_subtotal, tax as rli_refund_total_tax, currency as rli_currency_code,
           subtotal as rli_refund_subtotal_total_line, subtotal / quantity::double as rli_refund_subtotal_per_unit,
           rsl_title as rsl_shipping_title, rsl_price as rsl_shipping_price,
           rsl_price as rsl_shipping_discounted_price, rsl_source as rsl_shipping_source,
           rsl_currency as rsl_currency_code, rsl_price as rsl_shipping_discounted_price_total,
           rsl_price as rsl_shipping_discounted_price_per_unit
    from picked
"""
_BRAND_FULL = "'Store ' || right(brand, 1)"

ORACLES = {
    "shipping_outer": f"""
    select brand, order_id, cast(l_shipdate as varchar) as updated_at, case when l_returnflag <> 'N' then 'Standard' end as title,
           case when l_returnflag <> 'N' then 0 end::bigint as "at"
    from ({LINES})
""",
    "attributes_default": f"""
    select distinct brand, order_id, case when l_orderkey % 5 in (1, 2, 3) then 0 else 4 end::bigint as attributes, false as missing from ({LINES})
""",
    "discount_text": _EXPLODED
    + """
    select brand, order_id, line_item_id, cast(l_shipdate as varchar) as updated_at, batch_id,
           case when line_item_discount_total is null then 0 else 2 end::bigint as allocations,
           case when line_item_discount_total is not null then l_extendedprice * l_discount end as amount_0,
           case when line_item_discount_total is not null then l_tax end as amount_1
    from staged
""",
    "null_elements": f"""
    with li as ({LINES})
    select brand, 0::bigint as element_pos, count(*) as lines, 0::bigint as with_id, 0::bigint as with_price, null::double as price from li group by 1
    union all
    select brand, 1, count(*), count(*), count(*), sum(l_extendedprice::decimal(18,2))::double from li group by 1
    union all
    select brand, 2, count(*), count(*), 0, null from li group by 1
""",
    "personal_data": """
    select 'order_lines' as feed, '' as columns, 0::bigint as cells
    union all select 'refunds', '', 0
    union all select 'marketplace_lines', '', 0
    union all select 'returns', '', 0
    union all select 'returns_asked', 'return_reason_text', 2 * count(*) from orders where o_orderpriority <> '5-LOW'
""",
    "rejected_payloads": f"""
    select brand, order_id, cast(l_shipdate as varchar) as updated_at from ({LINES})
    where l_orderkey % 7 = 0 or l_orderkey % 11 = 0
""",
    "both_connectors_refunds": _LEGACY_REFUNDS
    + f"""
    select brand, refund_id as refund_record_id,
           'Storefront_' || brand || '_' || refund_line_item_id || '_' ||
               case when a_kind is not null then 'refund_shipping_line' else 'refund_line_item' end as refund_key,
           0.0::double - abs(coalesce(a_amount, subtotal)) as refund_amount
    from picked where record_type = 'refund_line_item' or a_kind = 'shipping_refund'
""",
    "explode_json_lines": _EXPLODED + _STAGED_SQL,
    "explode_native_lines": _EXPLODED + _STAGED_SQL,
    "line_discounts": _EXPLODED
    + f"""
    select 'Storefront' as source_platform, brand, order_id, line_item_id, line_item_discount_total,
           line_item_discount_per_unit
    from staged {_LATEST_LINE}
""",
    "attributes_map": f"""
    with li as ({LINES}), latest as ({_LATEST_ORDER})
    select brand, order_id, client_order_id, order_type, card_last4, utm_source, null as utm_medium,
           null as utm_campaign, null as utm_term, null as utm_content, null as custom1, null as custom2,
           4::bigint as attributes
    from latest
""",
    "shipping_lines": f"""
    with li as ({LINES})
    select brand, order_id, line_id as shipping_line_id, 'Standard' as shipping_title,
           l_tax * 100 as shipping_price, 'STD' as shipping_code, false as is_removed,
           0.0::double + l_discount as shipping_discount, '#' || order_id as order_name,
           cast(l_shipdate as varchar) as event_date
    from li where l_returnflag = 'R'
""",
    "shipping_mart": f"""
    with li as ({LINES}),
    picked as (
        select * from (select *, line_id as line_item_id from li)
        where l_returnflag = 'R' and l_tax * 100 <> 0 {_LATEST_LINE}
    )
    select brand, {_BRAND_FULL} as brand_full, order_id, line_item_id,
           'Storefront_' || brand || '_' || order_id || '_' || line_item_id || '_shipping_sale' as order_line_key,
           'Storefront_' || brand || '_shipping' as product_key, cast(l_shipdate as varchar) as purchase_date,
           cast({pacific('l_shipdate')} as varchar) as purchase_date_pst,
           cast(l_shipdate as varchar) as last_updated_date, 'USD' as currency,
           l_tax * 100 as shipping_price_total, 0.0::double + l_discount as shipping_promotion_discount_total,
           case when l_linestatus = 'F' then 'paid-fulfilled' else 'paid' end as status
    from picked
""",
    "connector_union": _EXPLODED
    + f"""
    select brand, order_id, line_item_id, quantity, product_price, batch_id from staged where brand not in {MOVED}
    union all
    select brand, order_id, line_item_id, quantity, product_price, null from staged
""",
    "storefront_mart": _EXPLODED
    + f""",
    notes as ({_LATEST_ORDER}),
    picked as (select * from staged where l_returnflag <> 'A' {_LATEST_LINE}),
    keyed as (select *, coalesce(nullif(product_sku, ''), product_title) as sku_or_title from picked)
    select 'Storefront' as source_platform, 'web' as source_name, brand, order_id, order_id as order_name_number,
           line_item_id, sku_or_title as product_sku, item_name,
           'Storefront_' || brand || '_' || order_id || '_' || line_item_id || '_sale' as order_line_key,
           'Storefront_' || brand || '_' || sku_or_title as product_key,
           cast(l_shipdate as varchar) as purchase_date, cast({pacific('l_shipdate')} as varchar) as purchase_date_pst,
           cast(l_shipdate as varchar) as event_date, cast({pacific('l_shipdate')} as varchar) as event_date_pst,
           cast(l_shipdate as varchar) as last_updated_date,
           cast({pacific('l_shipdate')} as varchar) as last_updated_date_pst,
           case when l_linestatus = 'F' then cast(l_shipdate as varchar) end as closed_at,
           case when l_linestatus = 'F' then cast({pacific('l_shipdate')} as varchar) end as closed_at_pst,
           'USD' as currency, product_price as list_price, product_price as list_price_per_unit,
           {money('line_item_discount_per_unit * quantity')}::double as seller_discount,
           line_item_discount_per_unit as seller_discount_per_unit, null::double as platform_discount,
           quantity as units,
           {money('(product_price - line_item_discount_per_unit) * quantity')}::double as sales_amount,
           {money('product_price - line_item_discount_per_unit')}::double as sales_amount_per_unit,
           'sale' as row_type, case when l_linestatus = 'F' then 'paid-fulfilled' else 'paid' end as status,
           client_order_id, order_type, utm_source, null as utm_medium, null as utm_campaign, null as utm_term,
           null as utm_content, null as custom1, null as custom2, cast(loaded_at::date as varchar) as ds,
           {_BRAND_FULL} as brand_full
    from keyed join notes using (brand, order_id)
""",
    "refund_records": _LEGACY_REFUNDS + _RECORD_COLUMNS,
    "refund_records_native": _REFUNDED.format(shipping="", tie="") + _RECORD_COLUMNS,
    "refunds_canonical": _LEGACY_REFUNDS
    + f""",
    known as (select distinct brand, order_id from li where l_returnflag <> 'A'),
    kept as (
        select *, a_kind is not null as is_shipping, coalesce(a_amount, subtotal) as amount
        from picked join known using (brand, order_id)
        where record_type = 'refund_line_item' or a_kind = 'shipping_refund'
    )
    select brand, {_BRAND_FULL} as brand_full, order_id, refund_id as refund_record_id, refund_line_item_id,
           'Storefront_' || brand || '_' || refund_line_item_id || '_' ||
               case when is_shipping then 'refund_shipping_line' else 'refund_line_item' end as refund_key,
           'Storefront_' || brand || '_' || case when is_shipping then 'shipping' else sku end as product_key,
           case when is_shipping then 'refund_shipping_line' else 'refund_line_item' end as record_type,
           case when is_shipping then 'shipping' else sku end as rli_product_sku,
           case when is_shipping then 'Shipping Refund' end as rsl_shipping_title, 'USD' as currency,
           0.0::double - abs(amount) as refund_amount, 0.0::double - amount as refund_amount_raw,
           case when is_shipping then 0.0::double - abs(a_amount) end as shipping_refund_amount,
           quantity::bigint as rli_product_quantity, cast({pacific('l_shipdate')} as varchar) as refund_date,
           cast({pacific('l_shipdate')}::date as varchar) as refund_date_pt,
           cast(l_shipdate::date as varchar) as refund_date_utc
    from kept
""",
    "refund_overlap_check": _LEGACY_REFUNDS
    + f""",
    amounts as (
        select brand, order_id, record_type, {money('abs(coalesce(rsl_price, a_amount))')} as amount
        from picked where record_type = 'refund_shipping_line' or a_kind = 'shipping_refund'
    ),
    totals as (
        select brand, order_id, amount, count(*) filter (record_type = 'refund_shipping_line') as line_rows,
               count(*) filter (record_type = 'adjustment') as adjustment_rows
        from amounts group by all
    )
    select brand, order_id, amount::double as amount, line_rows, adjustment_rows,
           least(line_rows, adjustment_rows) as overlap_rows
    from totals where line_rows > 0 and adjustment_rows > 0
""",
}

ORACLES |= {
    "parsed_once_mart": ORACLES["storefront_mart"],
    "parsed_once_shipping": ORACLES["shipping_mart"],
    "parsed_once_rejected": f"select brand, order_id, cast(l_shipdate as varchar) as updated_at from ({LINES}) where l_orderkey % 7 = 0",
}
