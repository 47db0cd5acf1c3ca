"""What plans leave out: fields nobody reads, interpreted functions, joins by a few keys, second picks."""

from pyspark.sql import functions as F

from orderloom.operators.attributes import MAP, with_map
from orderloom.operators.joins import IN_ROW, with_lookup
from orderloom.plans import loads
from orderloom.plans import refunds as R
from orderloom.plans import storefront as S
from orderloom.sources import versions
from orderloom.sources.registry import StoreSource

LINES = """[{"id":1,"name":"n","vendor":"v","quantity":2,"price":"3.5","discount_allocations":[{"amount":"1"},null,{"amount":"x"},{"amount":2}]},7,
 null,{"id":"2.000","discount_allocations":[]}]"""


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def orders(spark):
    at = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    texts = [("1", LINES), ("2", "[]"), ("3", None), ("4", "{"), ("5", "{}")]
    rows = spark.createDataFrame(texts, "id string, line_items string")
    times = ["processed_at", "created_at", "updated_at", "cancelled_at", "closed_at"]
    return rows.select(
        "*", F.lit("Storefront").alias("source_platform"), F.lit("store_a").alias("brand"), F.lit("#1").alias("name"),
        F.lit("web").alias("source_name"), F.lit("b").alias("batch_id"), F.lit(1704067200000).alias("batch_runtime"), *[at.alias(c) for c in times],
    )


def refunds(spark):
    lines = """[{"id":5,"quantity":2,"subtotal":4.0,"line_item":[{"title":"t","price":"1.5"}],"subtotal_set":[{"presentment_money":[{"currency_code":"usd"}]}]},
     {"id":6,"line_item":{"title":"u"},"subtotal_set":{"presentment_money":{"currency_code":"eur"}}}]"""
    moves = '[{"id":7,"amount":"-1.5","kind":"refund_discrepancy","refund_id":9}]'
    rows = spark.createDataFrame([("1", lines, moves), ("2", lines, None), ("3", None, None), ("4", "[]", moves)], "id string, refund_line_items string, order_adjustments string")
    return rows.select(
        "*", F.lit("Storefront").alias("source_platform"), F.lit("store_a").alias("brand"), F.lit("8").alias("order_id"), F.lit("x").alias("note"),
        F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("created_at"), F.lit("b").alias("batch_id"), F.lit(1704067200000).alias("batch_runtime"),
    )


def test_fields_nobody_reads_are_not_cast(spark, rows):
    staged = S.stage_order_lines(orders(spark))
    assert "vendor" not in plan(staged.agg(F.count("*")))
    assert staged.count() == 4
    got = rows(staged, "order_id", "element_pos", "line_item_id", "vendor", "quantity", "product_price", "line_item_discount_total")
    assert got == [
        ("1", 0, "1", "v", 2.0, 3.5, 3.0), ("1", 1, None, None, None, None, None),
        ("1", 2, None, None, None, None, None), ("1", 3, "2", None, None, None, None),
    ]


def test_records_are_read_in_generated_code(spark, rows):
    records = R.refund_records(refunds(spark))
    assert "lambdafunction" not in plan(records)
    got = rows(records, "refund_record_id", "refund_line_item_id", "record_type", "a_amount", "rli_product_title", "rli_product_price", "rli_currency_code")
    assert got == [
        ("1", "5", "refund_line_item", None, "t", 1.5, "usd"), ("1", "6", "refund_line_item", None, "u", None, "eur"),
        ("1", "7", "adjustment", -1.5, None, None, None), ("2", "5", "refund_line_item", None, "t", 1.5, "usd"),
        ("2", "6", "refund_line_item", None, "u", None, "eur"), ("4", "7", "adjustment", -1.5, None, None, None),
    ]


def test_short_mappings_are_looked_up_in_the_row(spark, rows):
    stores = spark.createDataFrame([("A",), ("B",), (None,)], "brand string")
    short = with_lookup(stores, "brand", {"A": "Store A"}, "brand_full")
    assert "Join" not in plan(short)
    long = with_lookup(stores, "brand", {"A": "Store A"} | {f"x{i}": "x" for i in range(IN_ROW)}, "brand_full")
    assert rows(short) == rows(long) == [(None, None), ("A", "Store A"), ("B", "B")]
    assert rows(with_lookup(stores, "brand", {}, "brand_full")) == [(None, None), ("A", "A"), ("B", "B")]


def test_picks_sort_by_the_order_first(spark):
    picked = S.line_discounts(S.stage_order_lines(orders(spark)))
    assert "[order_id" in plan(picked).split("windowspecdefinition(")[0] or "windowspecdefinition(order_id" in plan(picked)


def test_map_keeps_the_last_of_equal_names(spark):
    notes = [('[{"name":"b","value":"1"},{"name":"a","value":"2"},{"name":"b","value":"3"},{"name":"c"},null]',), ("[]",), (None,), ("{",)]
    mapped = with_map(spark.createDataFrame(notes, "notes string"), "notes")
    assert [r[MAP] for r in mapped.collect()] == [{"a": "2", "b": "3"}, {}, {}, {}]


def test_refund_records_are_picked_once_per_load(spark, tmp_path, rows, monkeypatch):
    refunds(spark).drop("brand").write.parquet(str(tmp_path / "feed"))
    batches = []
    cut = versions.cut_lineage
    monkeypatch.setattr(versions, "cut_lineage", lambda df, *a, **o: (batches.append(plan(df)), cut(df, *a, **o))[1])
    table = str(tmp_path / "table")
    for _ in range(2):
        loads.load_refund_records(spark, [StoreSource("STORE_A", str(tmp_path / "feed"))], table)
    assert [b.count("row_number()") and b.count("Window [") for b in batches] == [1, 1]
    assert rows(versions.read(spark, table), "refund_record_id", "refund_line_item_id") == [("1", "5"), ("1", "6"), ("1", "7"), ("2", "5"), ("2", "6"), ("4", "7")]
