"""Storefront refunds: one typed record per refunded thing, then one canonical refund each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import keys as K
from orderloom.functions.ids import normalize_id
from orderloom.functions.money import safe_divide
from orderloom.functions.semi import Element, json_array, typed_array
from orderloom.functions.times import as_utc, to_pacific
from orderloom.operators.connectors import union_connectors
from orderloom.operators.dedup import keep_latest, row_hash
from orderloom.operators.joins import keep_existing
from orderloom.plans.columns import IDENTIFYING
from orderloom.plans.staging import with_load_time
from orderloom.sources.readers import with_brand_name
from orderloom.sources.registry import MIGRATED
from orderloom.sources.sinks import drop_pii

RECORD_KEY = ["brand", "refund_record_id", "refund_line_item_id", "record_type"]

# The key with its most selective column first: sorts compare its leading bytes first.
_PICKED_BY = ["refund_record_id", "refund_line_item_id", "record_type", "brand"]

# The fields of a refund record, in order, with their types. One group is filled per
# record type (a_: adjustment, rli_: refund line, rsl_: refund shipping line), the others are NULL.
RECORD = {
    "record_type": "string",
    "refund_line_item_id": "string",
    "a_amount": "double",
    "a_kind": "string",
    "a_reason": "string",
    "a_linked_refund_id": "string",
    "a_tax_amount": "double",
    "a_currency_code": "string",
    "rli_product_title": "string",
    "rli_product_sku": "string",
    "rli_product_price": "double",
    "rli_product_quantity": "int",
    "rli_restock_type": "string",
    "rli_refund_subtotal": "double",
    "rli_refund_total_tax": "double",
    "rli_currency_code": "string",
    "rli_refund_subtotal_total_line": "double",
    "rli_refund_subtotal_per_unit": "double",
    "rsl_shipping_title": "string",
    "rsl_shipping_price": "double",
    "rsl_shipping_discounted_price": "double",
    "rsl_shipping_source": "string",
    "rsl_currency_code": "string",
    "rsl_shipping_discounted_price_total": "double",
    "rsl_shipping_discounted_price_per_unit": "double",
}


# The fields of the payloads' elements; those without a type of their own differ in shape between connectors.
PAYLOADS = {
    "order_adjustments": {
        "id": "decimal(38,0)", "amount": "double", "kind": "string", "reason": "string", "refund_id": "decimal(38,0)",
        "tax_amount": "double", "amount_set": "variant",
    },
    "refund_line_items": {
        "id": "decimal(38,0)", "quantity": "int", "subtotal": "double", "restock_type": "string", "total_tax": "double",
        "line_item": "variant", "subtotal_set": "variant",
    },
    "refund_shipping_lines": {"id": "decimal(38,0)", "shipping_line": "variant", "price_set": "variant"},
}


def refund_records(refunds: DataFrame, strict: bool = True, allow: Sequence[str] = ()) -> DataFrame:
    """Typed refund records of both connectors, latest version per record.

    The three payload arrays of a refund lie one after the other in one explode of their positions,
    so the feed is scanned and parsed once. A malformed payload is an error unless ``strict`` is off.
    """
    rows = with_load_time(as_utc(refunds, "created_at"))
    columns = [
        "source_platform",
        F.upper("brand").alias("brand"),
        normalize_id(F.col("order_id")).alias("order_id"),
        normalize_id(F.col("id")).alias("refund_record_id"),
        "created_at",
        "note",
        "batch_runtime",
        "batch_id",
        "batch_date",
        "ds",
    ]
    out = _records(rows, columns, strict)
    out = keep_latest(out, _PICKED_BY, ["batch_runtime", "batch_date", "batch_id", "created_at", row_hash(out)])
    return drop_pii(out, IDENTIFYING, allow)


def known_orders(*orders: DataFrame) -> DataFrame:
    """The distinct (brand, order) keys of several feeds, for :func:`canonical_refunds`."""
    keys = [o.select(F.upper("brand").alias("brand"), "order_id") for o in orders]
    return reduce(DataFrame.unionByName, keys).distinct()


def canonical_refunds(
    legacy: DataFrame,
    replacement: DataFrame,
    orders: DataFrame,
    migrated: Sequence[str] = tuple(MIGRATED),
) -> DataFrame:
    """Refunds counted once: products, and shipping from the adjustments only.

    A shipping refund shows up as a refund shipping line and as an adjustment of kind
    ``shipping_refund``; the adjustment covers more, so it is the one kept, relabelled. Other
    adjustments are summaries and go. The refund's order must occur in ``orders`` (brand, order_id).
    ``refund_amount`` is negative for money returned; ``refund_amount_raw`` keeps the sign the
    record implies.
    """
    rows = union_connectors(legacy, replacement, migrated)
    # A refund that both connectors hold counts once, in its latest version.
    rows = keep_latest(rows, RECORD_KEY, ["batch_runtime", "batch_date", "batch_id", row_hash(rows)])
    is_shipping = F.col("a_kind") == "shipping_refund"
    rows = rows.where(
        F.col("refund_line_item_id").isNotNull()
        & ((F.col("record_type") == "refund_line_item") | is_shipping)
    )
    rows = keep_existing(rows, orders, ["brand", "order_id"])

    record_type = F.when(is_shipping, "refund_shipping_line").otherwise(F.col("record_type"))
    sku = F.when(
        F.col("rsl_shipping_title").isNotNull() | is_shipping, "shipping"
    ).otherwise(K.sku_or(F.col("rli_product_sku"), F.col("rli_product_title")))
    platform, brand = F.col("source_platform"), F.col("brand")
    at = F.col("created_at")
    amount = F.coalesce(F.col("a_amount"), F.col("rli_refund_subtotal"))
    shipping = F.when(is_shipping, F.col("a_amount")).otherwise(F.col("rsl_shipping_discounted_price"))
    out = rows.select(
        to_pacific(at).alias("refund_date"),
        F.to_date(to_pacific(at)).alias("refund_date_pt"),
        to_pacific(at).alias("refund_ts_pt"),
        at.alias("refund_ts_utc"),
        F.to_date(at).alias("refund_date_utc"),
        K.refund_key(platform, brand, F.col("refund_line_item_id"), record_type).alias("refund_key"),
        K.product_key(platform, brand, sku).alias("product_key"),
        record_type.alias("record_type"),
        "source_platform",
        "brand",
        "refund_record_id",
        "refund_line_item_id",
        "order_id",
        sku.alias("rli_product_sku"),
        "rli_product_title",
        F.coalesce(
            F.col("rsl_shipping_title"), F.when(is_shipping, "Shipping Refund")
        ).alias("rsl_shipping_title"),
        K.clean_currency(
            F.coalesce("a_currency_code", "rli_currency_code", "rsl_currency_code")
        ).alias("currency"),
        _given_back(amount).alias("refund_amount"),
        (F.lit(0.0) - amount).alias("refund_amount_raw"),
        "rli_product_quantity",
        _given_back(shipping).alias("shipping_refund_amount"),
        "batch_date",
        "ds",
    )
    return with_brand_name(out)


def _given_back(amount: Column) -> Column:
    return F.lit(0.0) - F.abs(amount)


def _adjustment(e: Element) -> dict[str, Column]:
    return {
        "record_type": F.lit("adjustment"),
        "refund_line_item_id": normalize_id(e.get("$.id", "decimal(38,0)")),
        "a_amount": e.get("$.amount", "double"),
        "a_kind": e.get("$.kind", "string"),
        "a_reason": e.get("$.reason", "string"),
        "a_linked_refund_id": normalize_id(e.get("$.refund_id", "decimal(38,0)")),
        "a_tax_amount": e.get("$.tax_amount", "double"),
        "a_currency_code": _currency(e, "amount_set"),
    }


def _refund_line(e: Element) -> dict[str, Column]:
    quantity, subtotal = e.get("$.quantity", "int"), e.get("$.subtotal", "double")

    def item(field: str, as_type: str) -> Column:
        return e.first_of([f"$.line_item.{field}", f"$.line_item[0].{field}"], as_type)

    return {
        "record_type": F.lit("refund_line_item"),
        "refund_line_item_id": normalize_id(e.get("$.id", "decimal(38,0)")),
        "rli_product_title": item("title", "string"),
        "rli_product_sku": item("sku", "string"),
        "rli_product_price": item("price", "double"),
        "rli_product_quantity": quantity,
        "rli_restock_type": e.get("$.restock_type", "string"),
        "rli_refund_subtotal": subtotal,
        "rli_refund_total_tax": e.get("$.total_tax", "double"),
        "rli_currency_code": _currency(e, "subtotal_set"),
        "rli_refund_subtotal_total_line": subtotal,
        "rli_refund_subtotal_per_unit": safe_divide(subtotal, quantity.cast("double")),
    }


def _shipping_line(e: Element) -> dict[str, Column]:
    def line(field: str, as_type: str) -> Column:
        return e.first_of([f"$.shipping_line.{field}", f"$.shipping_line[0].{field}"], as_type)

    discounted = line("discounted_price", "double")
    return {
        "record_type": F.lit("refund_shipping_line"),
        "refund_line_item_id": normalize_id(e.get("$.id", "decimal(38,0)")),
        "rsl_shipping_title": line("title", "string"),
        "rsl_shipping_price": line("price", "double"),
        "rsl_shipping_discounted_price": discounted,
        "rsl_shipping_source": line("source", "string"),
        "rsl_currency_code": _currency(e, "price_set"),
        "rsl_shipping_discounted_price_total": discounted,
        "rsl_shipping_discounted_price_per_unit": discounted,
    }


def _currency(e: Element, money_set: str) -> Column:
    return e.first_of(
        [
            f"$.{money_set}.presentment_money.currency_code",
            f"$.{money_set}[0].presentment_money[0].currency_code",
        ],
        "string",
    )


def _records(rows: DataFrame, columns: Sequence[str | Column], strict: bool) -> DataFrame:
    """A row per element of the payload arrays, with ``columns`` and the fields of its record.

    JSON elements are read as structs in one step; only what comes as an object or as an array stays a VARIANT in them. The records' fields are read
    above the explode, in generated code, and not in functions of arrays, which Spark interprets. Outside its own positions an array has no element,
    so fields of the other payloads are NULL.
    """
    payloads = {
        "order_adjustments": _adjustment,
        "refund_line_items": _refund_line,
        "refund_shipping_lines": _shipping_line,
    }
    arrays, kinds = {}, {}
    for name in payloads:
        if name in rows.columns:
            array, kind = json_array(rows, name, strict)
            if isinstance(kind, T.VariantType):
                array, kind = typed_array(rows, name, PAYLOADS[name], strict)
            arrays[name], kinds[name] = array, kind
    rows = rows.select(*columns, *[array.alias(f"__{name}") for name, array in arrays.items()])
    ends, end = {}, F.lit(0)
    for name in arrays:
        end = end + F.coalesce(F.array_size(f"__{name}"), F.lit(0))
        ends[name] = end
    kept = [c for c in rows.columns if c.removeprefix("__") not in arrays]
    rows = rows.select("*", *[e.alias(f"__end_{name}") for name, e in ends.items()])
    rows = rows.select("*", F.explode(F.when(end > 0, F.sequence(F.lit(0), end - 1))).alias("__at"))
    filled, begin = {}, F.lit(0)
    for name in arrays:
        made = payloads[name](Element(F.get(f"__{name}", F.col("__at") - begin), kinds[name], strict))
        begin = F.col(f"__end_{name}")
        made["record_type"] = F.when(F.col("__at") < begin, made["record_type"])
        for field, value in made.items():
            filled.setdefault(field, []).append(value.cast(RECORD[field]))
    none = [F.lit(None)]
    return rows.select(*kept, *[F.coalesce(*filled.get(n, none)).cast(kind).alias(n) for n, kind in RECORD.items()])
