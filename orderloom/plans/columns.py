"""Column lists of the feeds. They are the contract with the raw tables."""

from __future__ import annotations

# Storefront order columns that staging passes through unchanged.
STOREFRONT_TIMES = ["processed_at", "created_at", "updated_at", "cancelled_at", "closed_at"]
STOREFRONT_ORDER = [
    "cancel_reason", "confirmation_number", "name", "number", "order_number", "note", "source_name", "tags",
    "financial_status", "fulfillment_status", "currency", "presentment_currency",
    "current_subtotal_price", "current_total_discounts", "current_total_price", "current_total_tax",
    "subtotal_price", "total_discounts", "total_line_items_price", "total_price", "total_price_usd",
    "total_tax", "total_outstanding", "total_tip_received", "total_weight",
    "current_subtotal_price_set", "current_total_discounts_set", "current_total_price_set",
    "current_total_tax_set", "subtotal_price_set", "total_discounts_set", "total_line_items_price_set",
    "total_price_set", "total_tax_set", "total_shipping_price_set",
    "customer_locale", "buyer_accepts_marketing",
    "gateway", "payment_gateway_names", "payment_details", "processing_method",
    "discount_codes", "discount_applications",
    "landing_site", "landing_site_ref", "referring_site", "browser_ip",
    "tax_exempt", "taxes_included", "tax_lines", "estimated_taxes",
    "refunds", "user_id", "test",
]

# Fields of an order line and of a shipping line, with the types they are read as.
# Allocations stay a VARIANT, so that they can go out whole.
_ALLOCATIONS = "variant"
ORDER_LINE = {
    "id": "decimal(38,0)", "name": "string", "title": "string", "sku": "string", "vendor": "string",
    "fulfillment_service": "string", "quantity": "double", "price": "double",
    "discount_allocations": _ALLOCATIONS,
}
SHIPPING_LINE = {
    "id": "decimal(38,0)", "title": "string", "price": "double", "code": "string",
    "carrier_identifier": "string", "source": "string", "is_removed": "boolean",
    "discount_allocations": _ALLOCATIONS,
}

# Marketplace order columns: plain ones, then epoch-second times.
MARKETPLACE_ORDER = [
    "is_exchange_order", "delivery_option_name", "fulfillment_type", "auto_combine_group_id",
    "buyer_message", "cancel_order_sla_time", "cancel_reason", "cancellation_initiator", "cpf",
    "delivery_option_id", "delivery_type", "fast_delivery_program", "has_updated_recipient_address",
    "is_buyer_request_cancel", "is_cod", "is_on_hold_order", "is_replacement_order", "is_sample_order",
    "need_upload_invoice", "payment_method_name", "replaced_order_id", "seller_note",
    "shipping_provider", "shipping_provider_id", "shipping_type", "split_or_combine_tag",
    "user_id", "warehouse_id",
]
MARKETPLACE_TIMES = [
    "paid_time", "create_time", "update_time", "cancel_time", "collection_due_time", "collection_time",
    "delivery_due_time", "delivery_option_required_delivery_time", "delivery_sla_time",
    "fast_dispatch_sla_time", "pick_up_cut_off_time", "request_cancel_time", "rts_sla_time", "rts_time",
    "shipping_due_time", "tts_sla_time",
]
MARKETPLACE_LINE_TEXT = [
    "currency", "product_id", "product_name", "sku_id", "sku_name", "sku_image", "seller_sku",
    "package_status", "package_id",
]
MARKETPLACE_LINE_AMOUNTS = ["sale_price", "original_price", "seller_discount", "platform_discount"]
MARKETPLACE_LINE = {
    "id": "decimal(38,0)",
    **{c: "string" for c in MARKETPLACE_LINE_TEXT},
    **{c: "double" for c in MARKETPLACE_LINE_AMOUNTS},
    "item_tax": "array<struct<tax_amount:double>>",
    "rts_time": "bigint",
}
SHIPPING_FEES = [
    "shipping_fee", "shipping_fee_cofunded_discount", "shipping_fee_platform_discount",
    "shipping_fee_seller_discount", "original_shipping_fee",
]

# Statement transaction columns passed through.
TRANSACTION = [
    "order_id", "adjustment_amount", "adjustment_id", "adjustment_order_id", "associated_order_id",
    "estimated_release_time", "fee_tax_amount", "reserve_amount", "reserve_id", "reserve_status",
    "revenue_amount", "settlement_amount", "shipping_cost_amount",
]
STATEMENT_AMOUNTS = [
    "adjustment_amount", "fee_amount", "net_sales_amount", "revenue_amount", "settlement_amount",
    "shipping_cost_amount",
]

# Identifying columns that leave only on request. Contact columns are in none of the lists above.
IDENTIFYING = [
    "note", "browser_ip", "payment_details", "card_last4", "buyer_message", "cpf", "seller_note", "return_reason_text",
]
