"""Storefront line items and shipping lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import keys as K
from orderloom.functions.ids import normalize_id
from orderloom.functions.money import nonzero, safe_divide, to_money
from orderloom.functions.semi import array_sum, explode_array, json_array, typed_payload
from orderloom.functions.times import as_utc, to_pacific
from orderloom.operators.attributes import ATTRIBUTES, MAP, NOTE, attribute_columns, attributes_map
from orderloom.operators.connectors import union_connectors
from orderloom.operators.dedup import keep_latest, row_hash
from orderloom.plans.columns import (
    IDENTIFYING,
    ORDER_LINE,
    SHIPPING_LINE,
    STOREFRONT_ORDER,
    STOREFRONT_TIMES,
)
from orderloom.plans.staging import BATCH, add_missing, with_load_time
from orderloom.sources.readers import with_brand_name
from orderloom.sources.registry import MIGRATED, Platforms
from orderloom.sources.sinks import drop_pii

LINE_KEY = ["source_platform", "brand", "order_id", "line_item_id", "row_type"]
SHIPPING_KEY = ["source_platform", "brand", "order_id", "shipping_line_id", "row_type"]
ORDER_KEY = ["brand", "order_id"]

_PAYLOAD = ["line_items", "shipping_lines", "element"]

# Business update time first, then load time (``batch_runtime`` may be cut to seconds, ``batch_date`` is not), batch and
# position; picks end with a hash of the row, because one connector has no batch id.
VERSION_ORDER = ["updated_at", "batch_runtime", "batch_date", "batch_id", "element_pos"]


def explode_lines(orders: DataFrame, strict: bool = False) -> DataFrame:
    """One row per order line and order version, from JSON text or native arrays.

    The line's discount is the sum of the allocations in its own payload, taken inside the row:
    no join, and allocations of older versions are never added to newer ones.
    """
    rows = _order_rows(typed_payload(orders, "line_items", ORDER_LINE, strict))
    rows, line = explode_array(rows, "line_items", strict=strict, fields=ORDER_LINE)
    allocations = line.structs("$.discount_allocations", {"amount": "double"})
    quantity = line.get("$.quantity", "double")
    out = rows.select(
        *[c for c in rows.columns if c not in _PAYLOAD],
        normalize_id(line.get("$.id", "decimal(38,0)")).alias("line_item_id"),
        line.get("$.name", "string").alias("item_name"),
        line.get("$.title", "string").alias("product_title"),
        line.get("$.sku", "string").alias("product_sku"),
        line.get("$.vendor", "string").alias("vendor"),
        line.get("$.fulfillment_service", "string").alias("fulfillment_service"),
        quantity.alias("quantity"),
        line.get("$.price", "double").alias("product_price"),
        line.text("$.discount_allocations").alias("discount_allocations"),
        allocations.alias("__allocations"),
    )
    out = out.withColumn("line_item_discount_total", array_sum(F.col("__allocations"), "amount")).drop("__allocations")
    return out.withColumn(
        "line_item_discount_per_unit",
        safe_divide(F.coalesce(F.col("line_item_discount_total"), F.lit(0.0)), F.col("quantity")),
    )


def explode_shipping(orders: DataFrame, marketplace_tag: str, strict: bool = True) -> DataFrame:
    """One row per shipping line and order version; a malformed payload is an error unless ``strict`` is off.

    Orders whose e-mail domain names the marketplace are left out, and so are orders without an
    e-mail, whose origin cannot be told.
    """
    own = typed_payload(orders, "shipping_lines", SHIPPING_LINE, strict).where(~K.domain_mentions(F.col("email"), marketplace_tag))
    rows, line = explode_array(_order_rows(own), "shipping_lines", strict=strict, fields=SHIPPING_LINE)
    allocations = line.structs("$.discount_allocations", {"amount": "double"})
    rows = rows.withColumnRenamed("name", "order_name")
    out = rows.select(
        *[c for c in rows.columns if c not in _PAYLOAD],
        normalize_id(line.get("$.id", "decimal(38,0)")).alias("shipping_line_id"),
        line.get("$.title", "string").alias("shipping_title"),
        line.get("$.price", "double").alias("shipping_price"),
        line.get("$.code", "string").alias("shipping_code"),
        line.get("$.carrier_identifier", "string").alias("carrier_identifier"),
        line.get("$.source", "string").alias("shipping_source"),
        line.get("$.is_removed", "boolean").alias("is_removed"),
        allocations.alias("__allocations"),
    )
    return out.withColumn("shipping_discount", array_sum(F.col("__allocations"), "amount")).drop("__allocations")


def stage_order_lines(
    orders: DataFrame, allow: Sequence[str] = (), strict: bool = False
) -> DataFrame:
    """Staged order lines: every version, with Pacific times; attributes join later."""
    return _finish(explode_lines(orders, strict), allow)


def stage_shipping_lines(
    orders: DataFrame, platforms: Platforms = Platforms(), allow: Sequence[str] = (), strict: bool = True
) -> DataFrame:
    return _finish(explode_shipping(orders, platforms.marketplace_tag, strict), allow)


def orders_with_lines(orders: DataFrame) -> DataFrame:
    """The raw orders that :func:`stage_order_lines` has rows of: their line payload parses and is not empty."""
    return orders.where(F.size(json_array(orders, "line_items")[0]) > 0)


def line_discounts(lines: DataFrame) -> DataFrame:
    """Discount total and discount per unit of each line's latest version."""
    discounts = ["line_item_discount_total", "line_item_discount_per_unit"]
    latest = _newest(lines.select(*LINE_KEY, *discounts, *VERSION_ORDER), LINE_KEY)
    return latest.select(*LINE_KEY[:-1], *discounts)


def order_attributes(orders: DataFrame) -> DataFrame:
    """Attribute map per order, from the payload loaded last."""
    rows = with_load_time(typed_payload(orders, "note_attributes", NOTE)).select(
        F.upper("brand").alias("brand"),
        normalize_id(F.col("id")).alias("order_id"),
        "note_attributes",
        "batch_runtime",
        "batch_date",
        "batch_id",
    )
    newest = [F.col(c).desc_nulls_last() for c in ["batch_runtime", "batch_date", "batch_id"]]
    newest.append(F.xxhash64("note_attributes").desc())
    return attributes_map(rows, _by_order(ORDER_KEY), "note_attributes", newest).select(*ORDER_KEY, MAP)


def with_attributes(rows: DataFrame, attributes: DataFrame, allow: Sequence[str] = ()) -> DataFrame:
    """``rows`` with their order's attribute columns; call it on picked rows, not on all versions."""
    joined = rows.join(attributes, _by_order(ORDER_KEY), "left")
    joined = joined.select(*ORDER_KEY, *[c for c in joined.columns if c not in ORDER_KEY])
    hidden = [n for n, c in ATTRIBUTES.items() if c in IDENTIFYING and c not in allow]
    shown = F.map_filter(MAP, lambda name, _: ~name.isin(*hidden)) if hidden else F.col(MAP)
    columns = [c for c in joined.columns if c != MAP]
    out = joined.select(*columns, *attribute_columns(), shown.alias(MAP))
    return drop_pii(out, [c for c in ATTRIBUTES.values() if c in IDENTIFYING], allow)


def storefront_line_items(
    legacy: DataFrame,
    replacement: DataFrame,
    attributes: DataFrame | None = None,
    migrated: Sequence[str] = tuple(MIGRATED),
    platforms: Platforms = Platforms(),
    allow: Sequence[str] = (),
) -> DataFrame:
    """Current storefront line items: one row per natural key over both connectors."""
    columns = [
        "source_name", "order_name_number", "product_sku", "product_title", "item_name", "quantity",
        "product_price", "line_item_discount_per_unit", "processed_at", "event_date", "closed_at",
        "closed_at_pst", "currency", "financial_status", "fulfillment_status", "tags", "ds",
    ]
    rows = _union(legacy, replacement, LINE_KEY + columns, migrated)
    rows = rows.where(F.col("source_name") != platforms.marketplace_tag)
    rows = rows.withColumn("line_item_id", normalize_id("line_item_id"))
    # Rows are told apart by all their columns, but only what is read below is shuffled: the SKU and the state instead of what they are made of.
    rows = rows.withColumns(
        {
            "__row": row_hash(rows),
            "product_sku": K.sku_or(F.col("product_sku"), F.col("product_title")),
            "__state": K.order_state(F.col("financial_status"), F.col("fulfillment_status")),
        }
    )
    rows = keep_latest(rows, _by_order(LINE_KEY), [*VERSION_ORDER, "__row"])
    if attributes is not None:
        rows = with_attributes(rows, attributes, allow)

    platform, brand = F.col("source_platform"), F.col("brand")
    sku = F.col("product_sku")
    price, discount = F.col("product_price"), F.col("line_item_discount_per_unit")
    units, updated = F.col("quantity"), F.col("updated_at")
    out = rows.select(
        "source_platform",
        "source_name",
        "brand",
        "order_id",
        "order_name_number",
        "line_item_id",
        "product_sku",
        "item_name",
        K.order_line_key(
            platform, brand, F.col("order_id"), F.col("line_item_id"), F.col("row_type")
        ).alias("order_line_key"),
        K.product_key(platform, brand, sku).alias("product_key"),
        *_dates(updated),
        "closed_at",
        to_pacific(F.col("closed_at")).alias("closed_at_pst"),
        K.clean_currency(F.col("currency")).alias("currency"),
        price.alias("list_price"),
        price.alias("list_price_per_unit"),
        F.round(discount * units, 2).alias("seller_discount"),
        discount.alias("seller_discount_per_unit"),
        F.lit(None).cast("double").alias("platform_discount"),
        units.alias("units"),
        F.round((price - discount) * units, 2).alias("sales_amount"),
        to_money(price - discount).alias("sales_amount_per_unit"),
        "row_type",
        "tags",
        F.col("__state").alias("status"),
        *_attribute_names(rows),
        F.to_date("ds").alias("ds"),
    )
    return with_brand_name(out)


def storefront_shipping(
    legacy: DataFrame,
    replacement: DataFrame,
    attributes: DataFrame | None = None,
    migrated: Sequence[str] = tuple(MIGRATED),
    platforms: Platforms = Platforms(),
    allow: Sequence[str] = (),
) -> DataFrame:
    """Current storefront shipping lines that cost something."""
    columns = [
        "source_name", "order_name_number", "shipping_price", "shipping_discount", "shipping_title",
        "processed_at", "event_date", "currency", "financial_status", "fulfillment_status", "tags", "ds",
    ]
    rows = _union(legacy, replacement, SHIPPING_KEY + columns, migrated)
    rows = rows.where(
        nonzero(F.col("shipping_price")) & (F.col("source_name") != platforms.marketplace_tag)
    )
    rows = _newest(rows, SHIPPING_KEY)
    if attributes is not None:
        rows = with_attributes(rows, attributes, allow)

    platform, brand = F.col("source_platform"), F.col("brand")
    kind = F.lit("shipping")
    out = rows.select(
        "source_platform",
        "source_name",
        "brand",
        "order_id",
        "order_name_number",
        F.col("shipping_line_id").alias("line_item_id"),
        kind.alias("product_sku"),
        F.lit("Shipping").alias("item_name"),
        K.order_line_key(
            platform, brand, F.col("order_id"), F.col("shipping_line_id"), kind, F.col("row_type")
        ).alias("order_line_key"),
        K.product_key(platform, brand, kind).alias("product_key"),
        *_dates(F.col("updated_at")),
        K.clean_currency(F.col("currency")).alias("currency"),
        F.col("shipping_price").alias("shipping_price_total"),
        F.coalesce(F.col("shipping_discount"), F.lit(0.0)).alias("shipping_promotion_discount_total"),
        "row_type",
        "tags",
        K.order_state(F.col("financial_status"), F.col("fulfillment_status")).alias("status"),
        *_attribute_names(rows),
        F.to_date("ds").alias("ds"),
    )
    return with_brand_name(out)


def history_rows(lines: DataFrame, key_columns: Sequence[str] = tuple(LINE_KEY)) -> DataFrame:
    """The current row per key, keyed for the history table: ``history_key``, ``updated_at_utc``."""
    latest = _newest(lines, key_columns)
    return latest.withColumns(
        {
            "history_key": K.history_key(*[F.col(c) for c in key_columns]),
            "updated_at_utc": F.col("updated_at"),
        }
    )


def _order_rows(orders: DataFrame) -> DataFrame:
    """Raw orders reduced to the columns staging keeps, ids and times in one form."""
    rows = add_missing(orders, STOREFRONT_ORDER)
    rows = with_load_time(as_utc(rows, *STOREFRONT_TIMES))
    payload = [c for c in _PAYLOAD if c in rows.columns]
    return rows.select(
        "source_platform",
        F.upper("brand").alias("brand"),
        normalize_id(F.col("id")).alias("order_id"),
        *STOREFRONT_TIMES,
        *STOREFRONT_ORDER,
        K.order_number(F.col("name")).alias("order_name_number"),
        *BATCH,
        *payload,
    )


def _finish(rows: DataFrame, allow: Sequence[str]) -> DataFrame:
    """Sale rows with Pacific times."""
    rows = rows.withColumns({"event_date": F.col("processed_at"), "row_type": F.lit("sale")})
    pacific = {
        "processed_at_pst": "processed_at",
        "event_date_pst": "event_date",
        "updated_at_pst": "updated_at",
        "cancelled_pst": "cancelled_at",
        "closed_at_pst": "closed_at",
    }
    rows = rows.withColumns({new: to_pacific(F.col(old)) for new, old in pacific.items()})
    return drop_pii(rows, IDENTIFYING, allow)


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return keep_latest(rows, _by_order(keys), [*VERSION_ORDER, row_hash(rows)])


def _by_order(keys: Sequence[str]) -> list[str]:
    """The keys with the order first: sorts compare the leading bytes of their first column, of which platforms and stores have few."""
    return sorted(keys, key=lambda k: k != "order_id")


def _union(
    legacy: DataFrame, replacement: DataFrame, columns: Sequence[str], migrated: Sequence[str]
) -> DataFrame:
    wanted = legacy.select(*columns, *VERSION_ORDER)
    return union_connectors(wanted, replacement, migrated)


def _dates(updated: Column) -> list[Column]:
    return [
        F.col("processed_at").alias("purchase_date"),
        to_pacific(F.col("processed_at")).alias("purchase_date_pst"),
        F.col("event_date"),
        to_pacific(F.col("event_date")).alias("event_date_pst"),
        updated.alias("last_updated_date"),
        to_pacific(updated).alias("last_updated_date_pst"),
    ]


def _attribute_names(rows: DataFrame) -> list[str]:
    return [c for c in [*ATTRIBUTES.values(), MAP] if c in rows.columns]
