"""Strings and business keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_ws_strict(sep: str, *parts: Column) -> Column:
    """Joined text that is NULL when any part is NULL, unlike ``concat_ws``, which skips it."""
    return reduce(lambda left, right: F.concat(left, F.lit(sep), right), parts)


def sku_or(sku: Column, fallback: Column) -> Column:
    """The SKU, or the fallback when the SKU is NULL or empty."""
    return F.coalesce(F.nullif(sku, F.lit("")), fallback)


def clean_currency(col: Column) -> Column:
    return F.upper(F.trim(col))


def order_line_key(platform: Column, brand: Column, order_id: Column, *rest: Column) -> Column:
    return concat_ws_strict("_", platform, F.upper(brand), order_id, *rest)


def product_key(platform: Column, brand: Column, sku: Column) -> Column:
    return concat_ws_strict("_", platform, F.upper(brand), sku)


def refund_key(platform: Column, brand: Column, line_id: Column, record_type: Column) -> Column:
    return concat_ws_strict("_", platform, F.upper(brand), line_id, record_type)


def event_key(platform: Column, brand: Column, event_id: Column) -> Column:
    return concat_ws_strict("_", platform, F.upper(brand), event_id)


def history_key(*parts: Column) -> Column:
    return concat_ws_strict("|", *parts)


def order_state(financial: Column, fulfillment: Column) -> Column:
    """``paid-fulfilled``; an order that is not fulfilled yet keeps the payment state alone."""
    return F.concat_ws("-", financial, fulfillment)


def email_domain(col: Column) -> Column:
    return F.split_part(col, F.lit("@"), F.lit(2))


def domain_mentions(email: Column, word: str) -> Column:
    """Case-blind test of the e-mail's domain; NULL for a NULL e-mail."""
    return F.contains(F.lower(email_domain(email)), F.lit(word.lower()))


def order_number(name: Column) -> Column:
    return F.replace(name, F.lit("#"), F.lit(""))
