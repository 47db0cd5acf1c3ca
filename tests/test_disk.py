"""What loads leave on disk: no copy of a batch that begins a table, no second shuffle of rows on their way into buckets, no shuffle files after a write."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom import session
from orderloom.catalog import QUERIES as CATALOG
from orderloom.operators.incremental import MARK
from orderloom.plans import fees as P
from orderloom.sources import versions as V
from tests.test_statements import BASE, FEE


@pytest.fixture
def small(spark, tmp_path):
    """Tables of one order with one line."""
    at = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    one = spark.range(1, 2)
    line = {"l_orderkey": F.col("id"), "l_partkey": F.col("id"), "l_suppkey": F.col("id"), "l_linenumber": F.lit(1)}
    line |= {c: F.lit(0.5) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    one.select(*[c.alias(n) for n, c in line.items()], F.lit("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), at.alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    order = {"o_orderkey": F.col("id"), "o_custkey": F.col("id"), "o_orderstatus": F.lit("F"), "o_totalprice": F.lit(0.5), "o_orderdate": at, "o_orderpriority": F.lit("1-URGENT")}
    one.select(*[c.alias(n) for n, c in order.items()]).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def plans(spark, monkeypatch):
    """The plans of what is written while a test runs."""
    seen = []
    from pyspark.sql import DataFrameWriter

    write = DataFrameWriter.parquet

    def parquet(self, *args, **options):
        seen.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def batch(spark, first, rows, value):
    return spark.range(first, first + rows, 1, 8).select("id", F.lit(value).alias("v"))


@pytest.mark.parametrize("mode", ["append", "reload"])
def test_rows_that_begin_a_table_are_written_once(spark, path, plans, mode):
    assert V.write(spark, path, batch(spark, 0, 100, "a"), ["id"], mode=mode) == 0
    assert len(plans) == 1 and "Rebalance" not in plans[0]
    assert V.read(spark, path).count() == 100


def test_merged_rows_are_not_shuffled_again(spark, path, plans):
    V.write(spark, path, batch(spark, 0, 100, "a"), ["id"], mode="reload")
    V.write(spark, path, batch(spark, 50, 100, "b"), ["id"], mode="reload")
    assert not any("Rebalance" in p for p in plans)
    assert V.read(spark, path).groupBy("v").count().orderBy("v").collect() == [("a", 50), ("b", 100)]


def test_more_buckets_than_open_files_are_rebalanced(spark, path, plans):
    V.write(spark, path, batch(spark, 0, 1000, "a"), ["id"], mode="append", buckets=40)
    assert "Rebalance" in plans[0]
    assert V.read(spark, path).count() == 1000 and len(V.manifest(spark, path).folders) == 40


@pytest.mark.parametrize("mode", ["append", "reload"])
def test_a_writer_that_comes_second_keeps_both_batches(spark, path, monkeypatch, mode):
    """The first attempt went straight into a table that another writer made meanwhile."""
    publish, other = V._publish, []

    def late(spark, path, version):
        if not other:
            other.append(True)
            V.write(spark, path, batch(spark, 0, 60, "first"), ["id"], mode="append")
        publish(spark, path, version)

    monkeypatch.setattr(V, "_publish", late)
    assert V.write(spark, path, batch(spark, 50, 50, "second"), ["id"], mode=mode) == 1
    got = {r["v"]: r["count"] for r in V.read(spark, path).groupBy("v").count().collect()}
    assert got == ({"first": 60, "second": 50} if mode == "append" else {"first": 50, "second": 50})


def test_tasks_of_a_write_follow_the_size(spark, tmp_path):
    spark.range(0, 100_000, 1, 64).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    assert session.few_tasks(small).rdd.getNumPartitions() == 1
    unknown = spark.range(0, 100, 1, 8).rdd.toDF()
    assert session.few_tasks(unknown).rdd.getNumPartitions() == 8


def test_shuffle_files_go_with_the_write(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folders = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {str(f) for folder in folders for f in Path(folder).rglob("shuffle_*.data")}

    before, held = spark.conf.get(setting), files()
    out = session.cut_lineage(spark.range(10_000).repartition(4, "id"), "cut")
    until = time.time() + 10
    while files() - held and time.time() < until:
        time.sleep(0.1)
    assert not files() - held
    assert spark.conf.get(setting) == before and out.count() == 10_000


def test_arriving_statements_are_assembled_once(spark, rows, plans):
    """The second load reads marks of a known size and joins each feed once, with what it assembled written."""
    head = spark.createDataFrame(
        [("A", BASE, "usd", f"ST{n}", "x", 1.0, 0.0, 1.0, f"S{n}", n) for n in (1, 2)],
        "brand string, create_time bigint, currency string, id string, status string, payable_amount double, "
        "total_reserve_amount double, total_settlement_amount double, batch_id string, batch_runtime bigint",
    )
    rest = [c for c in P.TRANSACTION if c not in ("order_id", "adjustment_amount")]
    tx = spark.createDataFrame(
        [("A", f"t{n}", "o1", "-3", f"T{n}", f"S{n}", n) for n in (1, 2)],
        "brand string, id string, order_id string, adjustment_amount string, batch_id string, parent_batch_id string, batch_runtime bigint",
    ).withColumns({"type": F.lit("ORDER"), "order_create_time": F.lit(BASE), **{c: F.lit(None).cast("string") for c in rest}})
    fees = spark.createDataFrame([("A", FEE, "[]", "B1", "T1", 1)], "brand string, fee string, tax string, batch_id string, parent_batch_id string, batch_runtime bigint")
    old = P.load_statement_transactions(None, *[f.where("batch_runtime = 1") for f in (head, tx, fees)])
    loaded = P.load_statement_transactions(old, head, tx, fees)
    assert rows(loaded, "transaction_id", "breakdown_batch_id") == [("t1", "B1"), ("t2", None)]
    assert MARK not in loaded._jdf.queryExecution().optimizedPlan().toString()


def test_the_ledger_query_carries_what_it_reads(spark, small):
    plan = CATALOG["ledger_lines"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    picked = plan[plan.index("min_by(") : plan.index(" AS first#")]
    assert "seller_sku" in picked and "delivery_option_name" not in picked and "tracking" not in picked


def test_the_mart_picks_rows_of_what_it_reads(spark, small):
    plan = CATALOG["storefront_mart"](spark, small)._jdf.queryExecution().executedPlan().toString()
    # The columns of the rows that meet their attributes, and of both connectors' rows before their pick.
    carried = [line for line in plan.splitlines() if "Project [" in line and "__state" in line]
    assert carried and not any("closed_at_pst" in line.split(" AS __row")[0].split("xxhash64(")[0] for line in carried)
