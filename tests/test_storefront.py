import datetime as dt
import json
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.semi import parse_payloads, rejected_payloads
from orderloom.operators.attributes import MAP
from orderloom.operators.connectors import reconcile, reconcile_summary, union_connectors
from orderloom.operators.quality import (
    check_id_consistency,
    check_id_format,
    check_refund_overlap,
    check_unique,
    source_freshness,
)
from orderloom.plans import refunds as R
from orderloom.plans import storefront as S
from orderloom.sources import derived as D
from orderloom.sources.readers import brand_map, read_stores, with_brand_name
from orderloom.sources.registry import MIGRATED, STORE_NAMES, StoreSource, store_mappings
from orderloom.sources.sinks import register_view

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def line(id, sku="S1", price="10", quantity=2, allocations=(), title="Shirt"):
    return {
        "id": id, "name": "Shirt - red", "title": title, "sku": sku, "vendor": "V", "fulfillment_service": "manual",
        "quantity": quantity, "price": price, "discount_allocations": [{"amount": a} for a in allocations],
    }


ORDER = (
    "source_platform string, brand string, id string, line_items string, shipping_lines string, "
    "note_attributes string, email string, source_name string, processed_at timestamp_ntz, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, cancelled_at timestamp_ntz, closed_at timestamp_ntz, name string, currency string, "
    "financial_status string, fulfillment_status string, batch_id string, batch_runtime bigint, browser_ip string"
)


def order(brand, id, lines, updated=T1, runtime=1, shipping=None, notes=None, email="a@mail.com", source="web", batch="b1"):
    def text(value):
        return value if value is None or isinstance(value, str) else json.dumps(value)

    return (
        "Storefront", brand, id, text(lines), text(shipping), text(notes), email, source, T1, T1, updated, None, None,
        "#" + id.split(".")[0], " usd ", "paid", None, batch, runtime, "10.0.0.1",
    )


def orders(spark, *data):
    return spark.createDataFrame(list(data), ORDER)


NATIVE_LINE = (
    "array<struct<id:string,name:string,title:string,sku:string,vendor:string,fulfillment_service:string,"
    "quantity:double,price:string,discount_allocations:array<struct<amount:string>>>>"
)


def native(df):
    """The same orders as the replacement connector sends them."""
    return df.select(
        *[c for c in df.columns if c not in {"line_items", "batch_id", "batch_runtime"}],
        F.from_json("line_items", NATIVE_LINE).alias("line_items"),
        F.timestamp_seconds(F.col("batch_runtime")).cast("timestamp_ntz").alias("extracted_at"),
    )


def test_lines_from_text_and_native_arrays_agree(spark, rows):
    raw = orders(
        spark,
        order("store_a", "7.000000000", [line("1.0", allocations=["1.5", "1.5"]), line("2", quantity=0)]),
        order("store_b", "8", "bad json"),
        order("store_b", "9", None),
    )
    columns = [
        "brand", "order_id", "line_item_id", "product_price", "quantity", "line_item_discount_total",
        "line_item_discount_per_unit", "order_name_number",
    ]
    expected = [
        ("STORE_A", "7", "1", 10.0, 2.0, 3.0, 1.5, "7"),
        ("STORE_A", "7", "2", 10.0, 0.0, None, None, "7"),
    ]
    text, arrays = S.stage_order_lines(raw), S.stage_order_lines(native(raw))
    assert rows(text, *columns) == expected
    assert rows(arrays, *columns) == expected
    assert text.columns == arrays.columns


def test_allocations_go_out_whole(spark):
    raw = orders(spark, order("a", "1", [line("1") | {"discount_allocations": [{"amount": "1.5", "index": 3}]}]))
    got = S.stage_order_lines(raw).first()
    assert json.loads(got["discount_allocations"]) == [{"amount": "1.5", "index": 3}]
    assert got["line_item_discount_total"] == 1.5


def test_identifying_columns_leave_only_on_request(spark):
    raw = orders(spark, order("a", "1", [line("1")]))
    staged = S.stage_order_lines(raw)
    assert "browser_ip" not in staged.columns and "email" not in staged.columns
    assert "browser_ip" in S.stage_order_lines(raw, allow=["browser_ip"]).columns


def test_discount_comes_from_the_latest_version_only(spark, rows):
    raw = orders(
        spark,
        order("a", "1", [line("5", allocations=["4"])], updated=T1, runtime=1),
        order("a", "1", [line("5.000000000", allocations=["1"])], updated=T2, runtime=2),
        order("b", "1", [line("5", allocations=["9"])], updated=T1, runtime=1),
    )
    assert rows(S.line_discounts(S.stage_order_lines(raw)), "brand", "line_item_discount_total") == [("A", 1.0), ("B", 9.0)]


def test_mart(spark, rows):
    notes = [{"name": "cardLast4", "value": "4242"}, {"name": "utm_source", "value": "ad"}]
    raw = orders(
        spark,
        order("store_a", "1", [line("1", price="9")], updated=T2, runtime=1),
        order("store_a", "1", [line("1.0", price="10", allocations=["1.005"])], updated=T2, runtime=2, notes=notes),
        order("store_a", "1", [line("1", price="8")], updated=T1, runtime=9, notes=notes),
        order("store_z", "1", [line("1", sku="", quantity=1)]),
        order("store_a", "2", [line("1", sku=None)], source="marketplace"),
        order("store_a", "3", [line("1")], source=None),
    )
    staged = S.stage_order_lines(raw)
    mart = S.storefront_line_items(staged, staged.limit(0), S.order_attributes(raw), migrated=[])
    assert rows(
        mart, "brand", "brand_full", "order_line_key", "product_key", "sales_amount", "seller_discount",
        "sales_amount_per_unit", "currency", "status", "utm_source",
    ) == [
        ("STORE_A", "Store A", "Storefront_STORE_A_1_1_sale", "Storefront_STORE_A_S1", 19.0, 1.01, 9.5, "USD", "paid", "ad"),
        ("STORE_Z", "STORE_Z", "Storefront_STORE_Z_1_1_sale", "Storefront_STORE_Z_Shirt", 10.0, 0.0, 10.0, "USD", "paid", None),
    ]
    assert "card_last4" not in mart.columns
    assert mart.where("brand = 'STORE_A'").first()[MAP] == {"utm_source": "ad"}
    assert check_unique(mart, S.LINE_KEY).count() == 0


def test_shipping(spark, rows):
    ship = [{"id": "5.0", "title": "Std", "price": "7.5", "discount_allocations": [{"amount": "1"}, {"amount": "0.5"}]}]
    raw = orders(
        spark,
        order("a", "1", [], shipping=ship),
        order("a", "2", [], shipping=ship, email="x@Marketplace.example"),
        order("a", "3", [], shipping=ship, email=None),
        order("a", "4", [], shipping=ship, email="no at sign"),
        order("a", "5", [], shipping=None),
        order("a", "6", [], shipping=[{"id": 1, "price": 0}]),
        order("a", "1", [], shipping=ship, updated=T2, runtime=5),
    )
    staged = S.stage_shipping_lines(raw)
    mart = S.storefront_shipping(staged, staged.limit(0), migrated=[])
    assert rows(mart, "order_id", "line_item_id", "shipping_price_total", "shipping_promotion_discount_total", "last_updated_date") == [
        ("1", "5", 7.5, 1.5, T2),
        ("4", "5", 7.5, 1.5, T1),
    ]


def test_connector_union_drops_migrated_legacy_rows(spark, rows):
    legacy = spark.createDataFrame([("STORE_A", 1), ("store_b", 2), (None, 3)], "brand string, v int")
    new = spark.createDataFrame([("STORE_A", 10, "x")], "brand string, v bigint, extra string")
    assert rows(union_connectors(legacy, new, ["STORE_A"])) == [("STORE_A", 10), ("store_b", 2)]
    assert union_connectors(legacy, new, []).count() == 4


def test_history_rows_have_one_row_per_key(spark, rows):
    raw = orders(spark, order("a", "1", [line("5")], T1), order("a", "1", [line("5.0")], T2), order("b", "1", [line("5")]))
    assert rows(S.history_rows(S.stage_order_lines(raw)), "history_key", "updated_at_utc") == [
        ("Storefront|A|1|5|sale", T2),
        ("Storefront|B|1|5|sale", T1),
    ]


def refund(brand, id, order_id, lines=None, adjustments=None, shipping=None, runtime=1):
    def text(v):
        return v if v is None or isinstance(v, str) else json.dumps(v)

    return ("Storefront", brand, id, order_id, T1, "n", text(lines), text(adjustments), text(shipping), runtime)


REFUND = (
    "source_platform string, brand string, id string, order_id string, created_at timestamp_ntz, note string, "
    "refund_line_items string, order_adjustments string, refund_shipping_lines string, batch_runtime bigint"
)
USD_ARRAY = [{"presentment_money": [{"currency_code": "usd"}]}]
USD_OBJECT = {"presentment_money": {"currency_code": "usd"}}


def refunds(spark, *data):
    return spark.createDataFrame(list(data), REFUND)


@pytest.mark.parametrize("wrap", [lambda x: x, lambda x: [x]])
def test_refund_lines_in_object_and_array_form(spark, rows, wrap):
    item = {"title": "Shirt", "sku": "S1", "price": "12"}
    lines = [
        {"id": "3.0", "quantity": 2, "subtotal": 20.0, "total_tax": 1, "line_item": wrap(item), "subtotal_set": wrap({"presentment_money": wrap({"currency_code": "usd"})})},
        {"id": 4, "quantity": 0, "subtotal": 5, "line_item": wrap(item)},
    ]
    out = R.refund_records(refunds(spark, refund("a", "9.0", "1.0", lines=lines)))
    assert rows(
        out, "brand", "order_id", "refund_record_id", "refund_line_item_id", "rli_product_sku", "rli_product_price",
        "rli_refund_subtotal_per_unit", "rli_currency_code", "record_type", "a_amount", "rsl_shipping_title",
    ) == [
        ("A", "1", "9", "3", "S1", 12.0, 10.0, "usd", "refund_line_item", None, None),
        ("A", "1", "9", "4", "S1", 12.0, None, None, "refund_line_item", None, None),
    ]


def test_refund_records_keep_the_latest_and_skip_empty_payloads(spark, rows):
    old = [{"id": 1, "amount": "-3", "kind": "shipping_refund"}]
    new = [{"id": 1, "amount": "-4", "kind": "shipping_refund", "refund_id": "9.0", "amount_set": USD_OBJECT}]
    out = R.refund_records(
        refunds(
            spark,
            refund("a", "9", "1", adjustments=old, runtime=1),
            refund("a", "9", "1", adjustments=new, runtime=2),
            refund("b", "9", "1", adjustments=old, runtime=1),
            refund("a", "10", "1"),
            refund("a", "11", "1", lines="[]", adjustments="bad"),
        ),
        strict=False,
    )
    assert rows(out, "brand", "a_amount", "a_linked_refund_id", "a_currency_code") == [("A", -4.0, "9", "usd"), ("B", -3.0, None, None)]
    with pytest.raises(Exception, match="MALFORMED"):
        R.refund_records(refunds(spark, refund("a", "1", "1", lines="bad"))).count()


def test_shipping_refund_counts_once(spark, rows):
    item = {"title": "Shirt", "sku": "S1", "price": "12"}
    raw = refunds(
        spark,
        refund(
            "a", "9", "1",
            lines=[{"id": 1, "quantity": 1, "subtotal": 20.0, "line_item": [item], "subtotal_set": USD_ARRAY}],
            adjustments=[
                {"id": 2, "amount": "-5.0", "kind": "shipping_refund", "amount_set": USD_ARRAY},
                {"id": 3, "amount": "1", "kind": "refund_discrepancy"},
            ],
            shipping=[{"id": 4, "shipping_line": [{"title": "Std", "price": 5, "discounted_price": 5}]}],
        ),
        refund("a", "10", "no such order", lines=[{"id": 1, "subtotal": 1, "line_item": [item]}]),
        refund("b", "9", "1", lines=[{"id": 1, "subtotal": 1, "line_item": [item]}]),
    )
    records = R.refund_records(raw)
    listed = spark.createDataFrame([("A", "1"), ("a", "1")], "brand string, order_id string")
    known = R.known_orders(listed, listed)
    assert known.count() == 1
    out = R.canonical_refunds(records, records.limit(0), known, migrated=[])
    assert rows(out, "refund_key", "record_type", "rli_product_sku", "refund_amount", "refund_amount_raw", "shipping_refund_amount", "currency") == [
        ("Storefront_A_1_refund_line_item", "refund_line_item", "S1", -20.0, -20.0, None, "USD"),
        ("Storefront_A_2_refund_shipping_line", "refund_shipping_line", "shipping", -5.0, 5.0, -5.0, "USD"),
    ]
    assert rows(check_refund_overlap(records), "brand", "order_id", "line_rows", "adjustment_rows", "overlap_rows") == [("A", "1", 1, 1, 1)]


def test_refunds_of_orders_without_lines_are_left_out(spark, rows, monkeypatch):
    from orderloom.catalog import storefront as catalog

    folder = "/root/testdata/sf0.001"
    whole = rows(catalog.refunds_canonical(spark, folder))
    number = F.col("id").cast("decimal(38,0)").cast("bigint")
    legacy, replacement = catalog._legacy(spark, folder), catalog._replacement(spark, folder)
    bad = {0: "[]", 1: "[{", 2: None, 3: "", 4: "{}"}
    text = F.col("line_items")
    for rest, payload in (bad | {5: "[1, null]", 6: '[{"id": {}, "quantity": "x"}]'}).items():
        text = F.when(number % 9 == rest, F.lit(payload)).otherwise(text)
    none = F.when(number % 2 == 0, F.expr("filter(line_items, x -> false)"))
    native = F.when(number % 9 < len(bad), none).otherwise(F.col("line_items"))
    damaged = [legacy.withColumn("line_items", text), replacement.withColumn("line_items", native)]
    for raw in damaged:
        staged = S.stage_order_lines(raw).select("brand", "order_id").distinct()
        assert rows(staged) == rows(R.known_orders(S.orders_with_lines(raw).withColumn("order_id", number.cast("string"))))
    monkeypatch.setattr(catalog, "_legacy", lambda *_: damaged[0])
    monkeypatch.setattr(catalog, "_replacement", lambda *_: damaged[1])
    out = catalog.refunds_canonical(spark, folder)
    left = [r for r in whole if int(r[out.columns.index("order_id")]) % 9 >= len(bad)]
    assert rows(out) == left and 0 < len(left) < len(whole)


def test_reconcile(spark, rows):
    schema = "k string, amount bigint"
    old = spark.createDataFrame([("same", 1), ("diff", 1), ("old", 1), ("dup", 2), ("dup", 3), (None, 1)], schema)
    new = spark.createDataFrame([("same", 1), ("diff", 2), ("new", 1), ("dup", 5), (None, 1)], schema)
    report = reconcile(old, new, ["k"], ["amount"])
    assert rows(report, "k", "rows_old", "rows_new", "status") == [
        (None, 1, 1, "same"),
        ("diff", 1, 1, "differs"),
        ("dup", 2, 1, "differs"),
        ("new", 0, 1, "only_new"),
        ("old", 1, 0, "only_old"),
        ("same", 1, 1, "same"),
    ]
    assert rows(reconcile_summary(report), "status", "keys") == [("differs", 2), ("only_new", 1), ("only_old", 1), ("same", 2)]


def test_quality_checks(spark, rows):
    df = spark.createDataFrame(
        [("a", "1", "5"), ("a", "1", "5.0"), ("a", "1", "5.0"), ("a", "2", "6"), ("a", "2", None), ("a", "2", "x"), ("b", "1", "5E0")],
        "brand string, order_id string, raw string",
    )
    assert rows(check_unique(df, ["brand", "order_id", "raw"]), "raw", "row_count") == [("5.0", 2)]
    assert rows(check_id_format([("m", df, "raw")], ["brand"]), "brand", "id_value") == [("a", "5.0"), ("a", "5.0"), ("b", "5E0")]
    found = check_id_consistency([("m", df, "raw")], ["brand", "order_id"])
    assert rows(found, "brand", "order_id", "distinct_formats", "format_examples") == [("a", "1", 2, "5, 5.0")]
    assert check_id_consistency([("m", df, "raw")], ["brand"], since=F.col("order_id") > "1").count() == 0
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    loads = spark.createDataFrame([(1704067200000,), (None,)], "ms bigint")
    assert tuple(source_freshness(loads, "ms", "ms", now).first()) == (dt.datetime(2024, 1, 1), 86400)


def test_stores_stack_with_their_tags(spark, rows, tmp_path):
    spark.createDataFrame([(1, "x")], "id int, only_a string").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(2, 9)], "ID2 int, other int").write.parquet(str(tmp_path / "b"))
    sources = [StoreSource("store_a", str(tmp_path / "a")), StoreSource("STORE_B", str(tmp_path / "b"), {"ID2": "id"})]
    out = read_stores(spark, sources, "Storefront")
    assert rows(out, "source_platform", "brand", "id", "only_a") == [("Storefront", "STORE_A", 1, "x"), ("Storefront", "STORE_B", 2, None)]
    text = out.where("brand = 'STORE_B'")._jdf.queryExecution().optimizedPlan().toString()
    assert "only_a#" not in text.split("Relation")[1] if "Relation" in text else True
    register_view(out, "stacked_stores")
    assert spark.table("stacked_stores").count() == 2


def test_registry(spark):
    registry = store_mappings("/lake/{feed}/{brand}")
    assert registry["marketplace_orders"][0] == StoreSource("STORE_A", "/lake/marketplace_orders/store_a")
    assert {len(registry[f]) for f in registry} == {2, 3, 6}
    assert set(MIGRATED) < set(STORE_NAMES)
    assert brand_map(spark).count() == len(STORE_NAMES)
    df = spark.createDataFrame([("STORE_A",), ("nope",), (None,)], "brand string")
    assert [r["brand_full"] for r in with_brand_name(df).collect()] == ["Store A", "nope", None]


def test_replacement_ties_do_not_depend_on_input_order(spark, rows):
    """Versions 0.8 s apart: the later one; versions that tie on every time: the same one whatever their order."""
    columns = ["source_platform", "brand", "order_id", "line_item_id", "product_sku", "list_price"]

    def mart(frames):
        raw = [native(orders(spark, order("store_x", "7", [line("1", sku=sku)]))).withColumn(
            "extracted_at", F.lit(at).cast("timestamp_ntz")) for sku, at in frames]
        staged = S.stage_order_lines(reduce(DataFrame.unionByName, raw).coalesce(1))
        return rows(S.storefront_line_items(staged.limit(0), staged, migrated=["STORE_X"]), *columns)

    apart = [("EARLY", "2024-01-01 00:00:00.1"), ("LATE", "2024-01-01 00:00:00.9")]
    assert mart(apart) == mart(apart[::-1]) and mart(apart)[0][4] == "LATE"
    tied = [("ONE", "2024-01-01"), ("TWO", "2024-01-01"), ("THREE", "2024-01-01")]
    assert mart(tied) == mart(tied[::-1]) == mart(tied[1:] + tied[:1])


def test_malformed_payloads_are_reported(spark, rows):
    raw = orders(spark, order("a", "1", [line("1")]), order("a", "2", "[{"), order("a", "3", '[{"id":1,"id":2}]'), order("a", "4", None))
    assert rows(rejected_payloads(raw, "line_items"), "id") == [("2",), ("3",)]
    assert rejected_payloads(native(raw), "line_items").count() == 0
    with pytest.raises(Exception, match="MALFORMED"):
        S.stage_shipping_lines(orders(spark, order("a", "1", None, shipping="[{"))).count()


def test_stored_payloads_are_parsed_once_and_read_by_path(spark, tmp_path):
    """The stored feed holds VARIANTs: staging parses no text, and its scan asks for the fields it needs, not for the payload."""
    lineitem = D.table(spark, "/root/testdata/sf0.001", "lineitem")
    raw = D.storefront_orders(lineitem)
    parse_payloads(raw, ["line_items", "shipping_lines", "note_attributes", "absent"]).write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    lines, notes = S.stage_order_lines(stored).drop("discount_allocations"), S.order_attributes(stored)
    for df in (lines, notes, S.stage_shipping_lines(stored)):
        assert "parse_json" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    read = lines._jdf.queryExecution().executedPlan().toString()
    schema = read[read.index("ReadSchema") :].split("\n")[0]
    assert "variant" not in schema and "array<struct" in schema
    for stage in (S.stage_order_lines, S.stage_shipping_lines):
        columns = [c for c, kind in stage(raw).dtypes if kind != "map<string,string>"]
        assert sorted(map(str, stage(stored).select(columns).collect())) == sorted(map(str, stage(raw).select(columns).collect()))


def test_payloads_that_do_not_parse(spark):
    df = spark.createDataFrame([(1, "[1]"), (2, "["), (3, None)], "k int, p string")
    got = {r.k: r for r in parse_payloads(df, ["p"]).selectExpr("k", "cast(p as string) p", "p_rejected").collect()}
    assert [got[k].p for k in (1, 2, 3)] == ["[1]", None, None] and [got[k].p_rejected for k in (1, 2, 3)] == [None, "[", None]
    assert [r.k for r in rejected_payloads(parse_payloads(df, ["p"]), "p").collect()] == [2]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse_payloads(df, ["p"], strict=True).collect()


def test_stored_feeds_are_packed(spark, tmp_path, monkeypatch):
    from orderloom.catalog import storefront as catalog

    monkeypatch.setattr(catalog, "shared_folder", lambda _, name: str(tmp_path / name))
    raw = spark.createDataFrame([("A", '[{"id":"1"}]'), ("B", None)], "brand string, line_items string")
    assert catalog._stored(spark, raw, "feed").count() == 2
    files = list(tmp_path.rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
