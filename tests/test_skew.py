"""One key with a third of all rows: results stay whole and no step gathers the key."""

import json

import pytest
from pyspark.sql import functions as F

from orderloom.operators.connectors import reconcile
from orderloom.operators.dedup import keep_latest
from orderloom.operators.history import scd2_merge
from orderloom.operators.joins import keep_existing
from orderloom.operators.merge import merge_upsert
from orderloom.operators.quality import check_unique
from orderloom.plans import fees as P
from orderloom.plans import marketplace as M
from orderloom.plans import storefront as S
from orderloom.sources import derived as D

N = 6_000


def hot(column="id"):
    """Key 0 for a third of the rows, else one of 200."""
    return F.when(F.col(column) % 3 == 0, F.lit(0)).otherwise(F.col(column) % 200)


@pytest.fixture(scope="module")
def lineitem(spark):
    """Line items where one order has a third of the lines."""
    n = F.col("id")
    return spark.range(N, numPartitions=4).select(
        hot().cast("bigint").alias("l_orderkey"),
        (n % 50).alias("l_partkey"),
        n.alias("l_suppkey"),
        (n % 7).cast("int").alias("l_linenumber"),
        (n % 5 + 1).cast("double").alias("l_quantity"),
        ((n % 1000) + 0.25).cast("double").alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"),
        F.lit(0.02).alias("l_tax"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (n % 3 + 1).cast("int")).alias("l_returnflag"),
        F.when(n % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.timestamp_add("SECOND", n * 7919 % N, F.lit("2024-01-01").cast("timestamp_ntz")).alias("l_shipdate"),
    )


def tree(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_every_window_is_limited_before_its_shuffle(spark, lineitem):
    staged = S.stage_order_lines(D.storefront_orders(lineitem))
    mart = S.storefront_line_items(staged, staged.limit(0), S.order_attributes(D.storefront_orders(lineitem)), migrated=[])
    for df in (mart, P.stage_statements(D.marketplace_statements(lineitem))):
        text = tree(df)
        assert text.count("Window [row_number()") == text.count("row_number(), 1, Partial") > 0


def test_ledger_aggregates_before_its_shuffle(spark, lineitem):
    returned = M.returns(D.marketplace_returns(_orders(lineitem)))
    text = tree(M.ledger_lines(M.stage_lines(D.marketplace_orders(lineitem)), returned))
    assert "partial_min_by" in text and "partial_max_by" in text
    assert "collect_list" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def _orders(lineitem):
    return lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("o_orderdate"), F.sum("l_extendedprice").alias("o_totalprice")
    ).withColumns({"o_custkey": F.col("o_orderkey"), "o_orderpriority": F.lit("1-URGENT")})


def test_hot_order_in_the_mart(spark, lineitem):
    raw = D.storefront_orders(lineitem)
    staged = S.stage_order_lines(raw)
    mart = S.storefront_line_items(staged, staged.limit(0), None, migrated=[])
    newest = {}
    for r in lineitem.where("l_returnflag <> 'A'").collect():
        key, rank = (r.l_orderkey, r.l_linenumber), (r.l_shipdate, r.l_partkey, str(r.l_suppkey))
        if key not in newest or rank > newest[key][0]:
            newest[key] = (rank, r.l_extendedprice)
    got = {
        (int(r["order_id"]), int(r["line_item_id"])): r["list_price"]
        for r in mart.where("units > 0").select("order_id", "line_item_id", "list_price").collect()
    }
    assert got == {k: price for k, (_, price) in newest.items()}


def test_hot_order_in_the_ledger(spark, lineitem):
    returned = M.returns(D.marketplace_returns(_orders(lineitem)))
    ledger = M.ledger_lines(M.stage_lines(D.marketplace_orders(lineitem)), returned)
    keys = lineitem.select("l_orderkey", "l_linenumber").distinct().count()
    counts = {r["row_type"]: r["count"] for r in ledger.groupBy("row_type").count().collect()}
    assert counts == {"cancellation": keys, "sale": keys}
    assert abs(ledger.agg(F.sum("sales_amount")).first()[0]) < 1e-6


def test_hot_order_with_many_skus_keeps_fee_totals(spark, lineitem):
    tx = P.assemble_transactions(*D.statement_feeds(_orders(lineitem), lineitem))
    total = P.fee_rows(tx).agg(F.sum("amount")).first()[0]
    assert tx.count() == N
    split = P.unpivot_fees(tx, P.order_skus(D.sku_bridge(lineitem)))
    assert split.agg(F.sum("amount")).first()[0] == total


def test_skewed_joins_split(spark, lineitem):
    """AQE splits the hot partition of a shuffled join once partitions count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        headers, tx, fees = D.statement_feeds(_orders(lineitem).checkpoint(), lineitem)
        joined = P.assemble_transactions(headers, tx, fees)
        assert len(joined.collect()) == N
        assert "isSkewJoin=true" in joined._jdf.queryExecution().executedPlan().toString() or "skew=true" in tree(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_in_merge_history_checks_and_reconciliation(spark, rows):
    base = spark.range(N).select(hot().alias("k"), "id", (F.col("id") * 31 % N).alias("ts"))
    picked = keep_latest(base, ["k"], ["ts", "id"])
    order = [F.col("ts").desc_nulls_last(), F.col("id").desc_nulls_last()]
    assert rows(merge_upsert(picked, base, ["k"], order)) == rows(picked)
    assert scd2_merge(scd2_merge(None, picked, ["k"], "ts"), picked, ["k"], "ts").count() == picked.count()
    assert check_unique(base, ["k"]).where("k = 0").first()["row_count"] >= N // 3
    assert reconcile(base, base, ["k"], ["ts"]).where("status <> 'same'").count() == 0
    assert keep_existing(base, base, ["k"]).count() == N


def test_one_order_with_a_huge_payload(spark):
    """An order's own arrays are read inside its row, whole."""
    lines = [{"id": i, "quantity": 1, "price": "2", "discount_allocations": [{"amount": "1"}] * 3} for i in range(5_000)]
    notes = [{"name": f"n{i % 40}", "value": i} for i in range(20_000)]
    raw = spark.createDataFrame(
        [("Storefront", "a", "1", json.dumps(lines), json.dumps(notes), "#1", 1, "b")],
        "source_platform string, brand string, id string, line_items string, note_attributes string, name string, "
        "batch_runtime bigint, batch_id string",
    ).withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("processed_at", "created_at", "updated_at", "cancelled_at", "closed_at")})
    out = S.stage_order_lines(raw).agg(F.count("*"), F.sum("line_item_discount_total"), F.count_distinct("line_item_id"))
    assert tuple(out.first()) == (5_000, 15_000.0, 5_000)
    attributes = S.order_attributes(raw).first()["note_attributes_map"]
    assert attributes == {f"n{i}": str(20_000 - 40 + i) for i in range(40)}
