"""Raw feeds derived, row by row, from order, line-item and event tables.

They give the pipelines inputs of the real shapes at any scale: each line item is one version of a
raw order row with its JSON payloads, so no group is ever collected to build one. Repeated (order,
line) pairs of the table are the repeated versions. Every derivation keeps all rows of its table,
except where a row's own status says that it has no such event (a refund, a return, a breakdown).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.times import to_seconds
from orderloom.session import fit_input

STORES = ["STORE_A", "STORE_B", "STORE_C", "STORE_D", "STORE_E", "STORE_F"]
MOVED = ["STORE_A", "STORE_C", "STORE_E"]
STOREFRONT, MARKETPLACE = "Storefront", "Marketplace"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    fit_input(spark, path)
    return spark.read.parquet(path)


def store_of(key: str) -> Column:
    """Store of an order, from its key."""
    letters = F.array(*[F.lit(s) for s in STORES])
    return F.element_at(letters, (F.col(key) % len(STORES) + 1).cast("int"))


def storefront_orders(lineitem: DataFrame, native: bool = False) -> DataFrame:
    """Raw storefront orders; ``native`` gives the replacement connector's arrays."""
    item = F.struct(
        _spelled("l_linenumber", _shipped()).alias("id"),
        F.concat(F.lit("Item "), "l_partkey").alias("name"),
        F.concat(F.lit("Part "), "l_partkey").alias("title"),
        F.when(_flag("N"), "").otherwise(_sku()).alias("sku"),
        F.concat(F.lit("V"), "l_suppkey").alias("vendor"),
        F.lit("manual").alias("fulfillment_service"),
        F.col("l_quantity").alias("quantity"),
        _text(F.col("l_extendedprice")).alias("price"),
        F.array(_amount(F.col("l_extendedprice") * F.col("l_discount")), _amount(F.col("l_tax"))).alias(
            "discount_allocations"
        ),
    )
    gift = F.struct(
        (F.col("l_linenumber") + 100).cast("string").alias("id"),
        F.lit("Gift").alias("name"),
        F.lit("Gift").alias("title"),
        F.lit(None).cast("string").alias("sku"),
        F.lit(None).cast("string").alias("vendor"),
        F.lit("manual").alias("fulfillment_service"),
        F.lit(0.0).alias("quantity"),
        F.lit("0").alias("price"),
        F.array().cast("array<struct<amount:string>>").alias("discount_allocations"),
    )
    shipping = F.struct(
        _spelled("l_linenumber", _shipped()).alias("id"),
        F.lit("Standard").alias("title"),
        _text(F.col("l_tax") * 100).alias("price"),
        F.lit("STD").alias("code"),
        F.lit(None).cast("string").alias("carrier_identifier"),
        F.lit("storefront").alias("source"),
        F.lit(False).alias("is_removed"),
        F.array(_amount(F.col("l_discount"))).alias("discount_allocations"),
    )
    notes = F.array(
        _named("orderType", F.col("l_linestatus")),
        _named("utm_source", F.col("l_returnflag")),
        _named("utm_source", F.concat(F.lit("line-"), "l_linenumber")),
        _named("clientOrderId", _text(F.col("l_partkey"))),
        _named("cardLast4", _text(F.col("l_suppkey"))),
    )
    payload = {
        "line_items": F.array(item, gift),
        "shipping_lines": F.when(~_flag("N"), F.array(shipping)),
        "note_attributes": notes,
    }
    seen = F.col("l_shipdate")
    rows = lineitem.select(
        F.lit(STOREFRONT).alias("source_platform"),
        store_of("l_orderkey").alias("brand"),
        _spelled("l_orderkey", F.col("l_orderkey") % 2 == 1).alias("id"),
        *[(c if native else F.to_json(c)).alias(n) for n, c in payload.items()],
        F.concat(
            F.lit("c"), "l_suppkey", F.when(_flag("A"), "@shop.marketplace.com").otherwise("@mail.com")
        ).alias("email"),
        F.when(_flag("A"), "marketplace").otherwise("web").alias("source_name"),
        seen.alias("processed_at"),
        seen.alias("created_at"),
        seen.alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("cancelled_at"),
        F.when(_shipped(), seen).alias("closed_at"),
        F.concat(F.lit("#"), "l_orderkey").alias("name"),
        F.lit(" usd ").alias("currency"),
        F.lit("paid").alias("financial_status"),
        F.when(_shipped(), "fulfilled").alias("fulfillment_status"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
    )
    if not native:
        return _loaded(rows)
    loaded = F.timestamp_add("SECOND", F.col("l_partkey"), F.col("l_shipdate"))
    return rows.withColumn("extracted_at", loaded).drop("l_shipdate", "l_partkey", "l_suppkey")


def storefront_refunds(lineitem: DataFrame, native: bool = False) -> DataFrame:
    """Raw refunds of the returned lines; ``native`` gives objects and arrays, without shipping lines."""
    money = F.struct(F.lit("usd ").alias("currency_code"))

    def wrap(inner: Column) -> Column:
        return inner if native else F.array(inner)

    money_set = wrap(F.struct(wrap(money).alias("presentment_money")))
    refund_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    line = F.struct(
        _spelled("l_linenumber", _shipped()).alias("id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.lit("return").alias("restock_type"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_tax").alias("total_tax"),
        wrap(
            F.struct(
                F.concat(F.lit("Part "), "l_partkey").alias("title"),
                _sku().alias("sku"),
                _text(F.col("l_extendedprice")).alias("price"),
            )
        ).alias("line_item"),
        money_set.alias("subtotal_set"),
    )
    cost = F.col("l_tax") * 100
    adjustment = F.struct(
        (F.col("l_linenumber") + 500).alias("id"),
        _text(F.lit(0.0) - F.when(_shipped(), cost).otherwise(F.col("l_discount"))).alias("amount"),
        F.when(_shipped(), "shipping_refund").otherwise("refund_discrepancy").alias("kind"),
        F.lit("refund").alias("reason"),
        refund_id.alias("refund_id"),
        F.lit(0.0).alias("tax_amount"),
        money_set.alias("amount_set"),
    )
    shipping = F.struct(
        (F.col("l_linenumber") + 900).alias("id"),
        F.array(
            F.struct(
                F.lit("Standard").alias("title"),
                _text(cost).alias("price"),
                _text(cost).alias("discounted_price"),
                F.lit("storefront").alias("source"),
            )
        ).alias("shipping_line"),
        money_set.alias("price_set"),
    )
    payload = {"refund_line_items": F.array(line), "order_adjustments": F.array(adjustment)}
    if not native:
        payload["refund_shipping_lines"] = F.when(_shipped(), F.array(shipping))
    rows = lineitem.where(_flag("R")).select(
        F.lit(STOREFRONT).alias("source_platform"),
        store_of("l_orderkey").alias("brand"),
        F.when(_shipped(), F.concat(refund_id.cast("string"), F.lit(".000000000")))
        .otherwise(refund_id.cast("string"))
        .alias("id"),
        _spelled("l_orderkey", F.col("l_orderkey") % 2 == 1).alias("order_id"),
        F.col("l_shipdate").alias("created_at"),
        F.lit("customer note").alias("note"),
        *[(c if native else F.to_json(c)).alias(n) for n, c in payload.items()],
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
    )
    if not native:
        return _loaded(rows)
    loaded = F.timestamp_add("SECOND", F.col("l_partkey"), F.col("l_shipdate"))
    return rows.withColumn("extracted_at", loaded).drop("l_shipdate", "l_partkey", "l_suppkey")


def marketplace_orders(lineitem: DataFrame) -> DataFrame:
    at = to_seconds(F.col("l_shipdate"))
    cancelled = _flag("A") & _shipped()
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    item = F.struct(
        F.lit("USD").alias("currency"),
        _spelled("l_linenumber", _shipped()).alias("id"),
        _text(F.col("l_partkey")).alias("product_id"),
        F.concat(F.lit("Part "), "l_partkey").alias("product_name"),
        _text(F.col("l_suppkey")).alias("sku_id"),
        F.when(~_flag("N"), F.concat(F.lit("Kind "), "l_suppkey")).alias("sku_name"),
        F.when(_flag("R"), "").otherwise(_sku()).alias("seller_sku"),
        _text(price * (1 - discount)).alias("sale_price"),
        _text(price).alias("original_price"),
        _text(price * discount).alias("seller_discount"),
        _text(tax).alias("platform_discount"),
        F.array(F.struct(_text(tax).alias("tax_amount"))).alias("item_tax"),
        F.when(_flag("R") & ~_shipped(), "CANCELLED_BY_SYSTEM").otherwise("DELIVERED").alias("package_status"),
        at.alias("rts_time"),
    )
    payment = F.struct(
        _text(tax * 100).alias("shipping_fee"),
        F.lit("0").alias("shipping_fee_cofunded_discount"),
        _text(discount).alias("shipping_fee_platform_discount"),
        _text(tax).alias("shipping_fee_seller_discount"),
        _text(tax * 100 + 1).alias("original_shipping_fee"),
        F.lit("usd ").alias("currency"),
    )
    rows = lineitem.select(
        F.lit(MARKETPLACE).alias("source_platform"),
        store_of("l_orderkey").alias("brand"),
        _text(F.col("l_orderkey")).alias("id"),
        F.to_json(F.array(item)).alias("line_items"),
        F.to_json(F.array(payment)).alias("payment"),
        F.concat(F.lit("T"), "l_suppkey").alias("tracking_number"),
        F.when(cancelled, "CANCELLED").otherwise("COMPLETED").alias("status"),
        F.when(_flag("A"), "Changed mind").alias("cancel_reason"),
        F.when(cancelled, at + 86400).alias("cancel_time"),
        F.when(_shipped(), at).alias("paid_time"),
        (at - 3600).alias("create_time"),
        (at + 7200).alias("update_time"),
        (at + 259200).alias("delivery_time"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
    )
    return _loaded(rows)


def marketplace_returns(orders: DataFrame) -> DataFrame:
    """Two versions of a return per order, its type by priority; low priority orders have none."""
    at = to_seconds(F.col("o_orderdate"))
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "REFUND")
        .when(F.col("o_orderpriority") == "2-HIGH", "RETURN_AND_REFUND")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "REPLACEMENT")
        .otherwise("EXCHANGE")
    )
    opened = F.struct(F.lit("REPLACEMENT").alias("return_type"), F.lit("OPEN").alias("return_status"), at.alias("update_time"))
    decided = F.struct(kind.alias("return_type"), F.lit("DONE").alias("return_status"), (at + 86400).alias("update_time"))
    amount = F.struct(
        F.lit("USD").alias("currency"),
        _text(F.col("o_totalprice")).alias("refund_total"),
        _text(F.col("o_totalprice")).alias("refund_subtotal"),
        F.lit("0").alias("refund_shipping_fee"),
        F.lit("0").alias("refund_tax"),
    )
    return orders.where(F.col("o_orderpriority") != "5-LOW").select(
        F.lit(MARKETPLACE).alias("source_platform"),
        store_of("o_orderkey").alias("brand"),
        _text(F.col("o_orderkey")).alias("order_id"),
        F.concat(F.lit("R"), "o_orderkey").alias("return_id"),
        F.lit("damaged").alias("return_reason"),
        F.lit("Item damaged").alias("return_reason_text"),
        F.to_json(F.array(amount)).alias("refund_amount"),
        at.alias("create_time"),
        _text(F.col("o_custkey")).alias("batch_id"),
        ((at + 86400) * 1000).alias("batch_runtime"),
        F.inline(F.array(opened, decided)),
    )


def marketplace_statements(lineitem: DataFrame) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    rows = lineitem.select(
        F.lit(MARKETPLACE).alias("source_platform"),
        store_of("l_orderkey").alias("brand"),
        _text(F.col("l_orderkey")).alias("id"),
        F.concat(F.lit("P"), "l_partkey").alias("payment_id"),
        F.when(_shipped(), "PAID").otherwise("PROCESSING").alias("payment_status"),
        _text(F.lit(0.0) - discount).alias("adjustment_amount"),
        _text(price * tax).alias("fee_amount"),
        _text(price * (1 - discount)).alias("net_sales_amount"),
        _text(price).alias("revenue_amount"),
        _text(price * (1 - discount)).alias("settlement_amount"),
        _text(tax * 100).alias("shipping_cost_amount"),
        F.lit(" usd ").alias("currency"),
        to_seconds(F.col("l_shipdate")).alias("statement_time"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
    )
    return _loaded(rows)


def statement_feeds(orders: DataFrame, lineitem: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Headers from orders, transactions from line items, breakdowns from the taxed line items."""

    def runtime(key: str) -> Column:
        return F.lit(1704067200000) + F.col(key) * 1000

    headers = orders.select(
        store_of("o_orderkey").alias("brand"),
        to_seconds(F.col("o_orderdate")).alias("create_time"),
        F.lit(" usd").alias("currency"),
        F.concat(F.lit("ST"), "o_orderkey").alias("id"),
        F.lit("SETTLED").alias("status"),
        F.col("o_totalprice").alias("payable_amount"),
        F.lit(0.0).alias("total_reserve_amount"),
        F.col("o_totalprice").alias("total_settlement_amount"),
        F.concat(F.lit("S"), "o_orderkey").alias("batch_id"),
        runtime("o_orderkey").alias("batch_runtime"),
    )
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", to_seconds(F.col("l_shipdate")))
    none = F.lit(None).cast("string")
    transactions = lineitem.select(
        store_of("l_orderkey").alias("brand"),
        line.alias("id"),
        F.when(_flag("R"), "REFUND").otherwise("ORDER").alias("type"),
        _text(F.col("l_orderkey")).alias("order_id"),
        to_seconds(F.col("l_shipdate")).alias("order_create_time"),
        F.when(_flag("R"), _text(F.lit(0.0) - F.col("l_discount"))).alias("adjustment_amount"),
        none.alias("adjustment_id"),
        none.alias("adjustment_order_id"),
        none.alias("associated_order_id"),
        none.alias("estimated_release_time"),
        _text(F.col("l_tax")).alias("fee_tax_amount"),
        none.alias("reserve_amount"),
        none.alias("reserve_id"),
        none.alias("reserve_status"),
        _text(F.col("l_extendedprice")).alias("revenue_amount"),
        _text(F.col("l_extendedprice")).alias("settlement_amount"),
        F.lit("0").alias("shipping_cost_amount"),
        F.concat(F.lit("T"), line).alias("batch_id"),
        F.concat(F.lit("S"), "l_orderkey").alias("parent_batch_id"),
        runtime("l_orderkey").alias("batch_runtime"),
    )
    price = F.col("l_extendedprice")
    fee = F.struct(
        _text(price * 0.06).alias("referral_fee_amount"),
        _text(price * F.col("l_discount")).alias("affiliate_ads_commission_amount"),
        _text(price * F.col("l_tax")).alias("tap_shop_ads_commission"),
        F.lit("9.99").alias("affiliate_commission_amount_before_pit"),
        F.col("l_quantity").alias("handling_fee_amount"),
    )
    breakdowns = lineitem.where("l_tax > 0").select(
        store_of("l_orderkey").alias("brand"),
        F.to_json(F.array(fee)).alias("fee"),
        F.lit("[]").alias("tax"),
        F.concat(F.lit("B"), line).alias("batch_id"),
        F.concat(F.lit("T"), line).alias("parent_batch_id"),
        runtime("l_orderkey").alias("batch_runtime"),
    )
    return headers, transactions, breakdowns


def sku_bridge(lineitem: DataFrame) -> DataFrame:
    """The SKUs of each order."""
    return lineitem.select(
        store_of("l_orderkey").alias("brand"),
        _text(F.col("l_orderkey")).alias("order_id"),
        _sku().alias("seller_sku"),
    ).distinct()


def _loaded(rows: DataFrame) -> DataFrame:
    """Load columns: a row arrives some seconds after its ship date."""
    seconds = to_seconds(F.col("l_shipdate")) + F.col("l_partkey")
    return rows.withColumns(
        {"batch_id": _text(F.col("l_suppkey")), "batch_runtime": seconds * 1000}
    ).drop("l_shipdate", "l_partkey", "l_suppkey")


def _spelled(key: str, as_decimal: Column) -> Column:
    """The id as the connector may spell it: ``5`` or ``5.000000000``."""
    text = F.col(key).cast("string")
    return F.when(as_decimal, F.concat(text, F.lit(".000000000"))).otherwise(text)


def _named(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def _amount(value: Column) -> Column:
    return F.struct(_text(value).alias("amount"))


def _text(value: Column) -> Column:
    return value.cast("string")


def _sku() -> Column:
    return F.concat(F.lit("SKU-"), "l_partkey")


def _flag(value: str) -> Column:
    return F.col("l_returnflag") == value


def _shipped() -> Column:
    return F.col("l_linestatus") == "F"
