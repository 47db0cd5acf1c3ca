"""Increments that skip files, marks from footers, and loads that break off or find new stores."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators.incremental import FLOOR, MARK, high_water, high_water_overall, increment, increment_by_store
from orderloom.operators.quality import source_freshness
from orderloom.plans import loads
from orderloom.plans import storefront as S
from orderloom.sources import derived as D
from orderloom.sources import versions
from orderloom.sources.readers import read_footers, read_increment, read_statement_feeds
from orderloom.sources.registry import StoreSource, store_mappings


def scanned(df):
    """Rows that the scans of an executed frame read from their files, by table."""

    def leaves(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return leaves(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return leaves(node.plan())
        children = [node.children().apply(i) for i in range(node.children().size())]
        return [leaf for child in children for leaf in leaves(child)] if children else [node]

    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return [leaf.metrics().apply("numOutputRows").value() for leaf in leaves(plan) if "parquet" in leaf.nodeName()]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Two stores with many row groups in order of load; one has rows without a time."""
    folder = str(tmp_path_factory.mktemp("feed"))
    for store, rows in (("a", 20_000), ("b", 20_000)):
        df = spark.range(rows).select(F.col("id").alias("loaded"), F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1)
        if store == "b":
            df = df.unionByName(spark.createDataFrame([(None, "no time")], "loaded long, v string")).coalesce(1)
        sizes = {"parquet.block.size": 1 << 16, "parquet.page.size": 1 << 13, "parquet.page.size.row.check.max": 100, "parquet.block.size.row.check.max": 100}
        df.write.options(**sizes, **{"parquet.enable.dictionary": "false"}).parquet(f"{folder}/{store}")
    return folder


def sources(feed):
    return [StoreSource(s, f"{feed}/{s.lower()}") for s in ("A", "b")]


def marks(spark, rows):
    return spark.createDataFrame(rows, f"brand string, {MARK} long")


def test_row_groups_below_a_mark_are_not_read(spark, feed):
    got = read_increment(spark, sources(feed), "P", marks(spark, [("A", 19_500), ("B", 19_900)]), "loaded")
    assert got.groupBy("brand").count().orderBy("brand").collect() == [("A", 500), ("B", 100)]
    read = scanned(got)
    assert len(read) == 2 and read[0] < 4000 and read[1] < 4000 + 4000
    assert sum(scanned(read_increment(spark, sources(feed), "P", None, "loaded"))) == 40_001
    later = scanned(read_increment(spark, sources(feed), "P", marks(spark, [("A", 10_000), ("B", 10_000)]), "loaded"))
    assert sum(read) < sum(later) < 40_001


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("floor", [None, 19_998])
@pytest.mark.parametrize("known", [[("A", 19_990), ("B", 5)], [("A", 19_990)], [("B", None)], []])
def test_by_store_equals_the_join(spark, feed, inclusive, floor, known):
    stores = [(s.brand.upper(), spark.read.parquet(s.location)) for s in sources(feed)]
    whole = stores[0][1].withColumn("brand", F.lit("A")).unionByName(stores[1][1].withColumn("brand", F.lit("B")))
    want = increment(whole, marks(spark, known), "brand", "loaded", inclusive, floor)
    got = increment_by_store(stores, marks(spark, known), "brand", "loaded", inclusive, floor)
    assert Counter(map(tuple, got.select(whole.columns).collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "int", "double", "string"])
def test_marks_of_other_types(spark, kind):
    values = {"int": [1, 2, 3, None], "double": [0.5, 1.5, 2.5, None], "string": ["a", "b", "c", None]}.get(kind, [*(dt.datetime(2024, 1, d) for d in (1, 2, 3)), None])
    if kind == "date":
        values = [v and v.date() for v in values]
    rows = spark.createDataFrame([(v,) for v in values], f"t {kind}")
    mark = spark.createDataFrame([("A", values[1])], f"brand string, {MARK} {kind}")
    got = increment_by_store([("A", rows), ("NEW", rows)], mark, "brand", "t")
    assert Counter(r.brand for r in got.collect()) == {"A": 2, "NEW": 4}
    after = increment_by_store([("A", rows), ("NEW", rows)], mark, "brand", "t", inclusive=False)
    assert Counter(r.brand for r in after.collect()) == {"A": 1, "NEW": 4}
    if kind.startswith("timestamp"):
        floored = increment_by_store([("A", rows), ("NEW", rows)], mark, "brand", "t", inclusive=False, floor=FLOOR)
        assert Counter(r.brand for r in floored.collect()) == {"A": 1, "NEW": 3}


def test_marks_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(1000).select(F.col("id").alias("loaded"), (F.col("id") % 3).cast("string").alias("brand")).write.partitionBy("brand").parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    table = read_footers(spark, path)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    by_store = high_water(table, "brand", "loaded")
    text = by_store._jdf.queryExecution().executedPlan().toString() + by_store._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(loaded)]" in text and "PushedGroupBy: [brand]" in text
    assert sorted(tuple(r) for r in by_store.collect()) == [(0, 999), (1, 997), (2, 998)]
    fresh = source_freshness(table, "loaded", "s", F.lit("1970-01-01 00:20:00").cast("timestamp_ntz"))
    assert "PushedAggregation: [MAX(loaded)]" in fresh._jdf.queryExecution().toString()
    assert fresh.first()["lag_seconds"] == 1200 - 999
    assert "PushedAggregation: [MAX(loaded)]" in high_water_overall(table, "loaded", 0)._jdf.queryExecution().toString()


def test_order_load_finds_new_stores_and_survives_a_broken_load(spark, tmp_path, monkeypatch):
    path, raw = str(tmp_path / "table"), str(tmp_path / "feed")
    lineitem = D.table(spark, "/root/testdata/sf0.001", "lineitem").where("l_orderkey < 300")
    orders = D.storefront_orders(lineitem)
    old = F.col("updated_at") < F.lit("1998-01-01").cast("timestamp_ntz")
    first = [StoreSource(s, f"{raw}/brand={s}") for s in D.STORES[:3]]
    every = [StoreSource(s, f"{raw}/brand={s}") for s in D.STORES]
    orders.where(old).write.partitionBy("brand").parquet(raw)
    assert loads.load_order_lines(spark, first, path) == 0
    orders.where(~old).write.mode("append").partitionBy("brand").parquet(raw)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            loads.load_order_lines(spark, every, path)
    assert loads.load_order_lines(spark, every, path) == 1
    want = S.stage_order_lines(orders).select(*S.LINE_KEY, "updated_at").distinct()
    got = versions.read(spark, path).select(*S.LINE_KEY, "updated_at").distinct()
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    # Nothing new: only rows on a mark come again.
    rows = versions.read(spark, path).count()
    loads.load_order_lines(spark, every, path)
    assert rows <= versions.read(spark, path).count() < rows + 100


def test_returns_load_from_the_floor_once(spark, tmp_path):
    path, raw = str(tmp_path / "table"), str(tmp_path / "feed")
    returned = D.marketplace_returns(D.table(spark, "/root/testdata/sf0.001", "orders"))
    returned.write.partitionBy("brand").parquet(raw)
    stores = [StoreSource(s, f"{raw}/brand={s}") for s in D.STORES]
    loads.load_returns(spark, stores, path)
    loads.load_returns(spark, stores, path)
    assert versions.read(spark, path).count() == returned.count()


def test_statement_feeds_of_the_registry(spark, tmp_path):
    """The three feeds of every store in the registry, one with a connector's own column name, from one mark per store on."""
    orders, lineitem = (D.table(spark, "/root/testdata/sf0.001", t) for t in ("orders", "lineitem"))
    names = ("statement_headers", "statement_transactions", "statement_breakdowns")
    registry = store_mappings(str(tmp_path) + "/{feed}/{brand}")
    made = dict(zip(names, D.statement_feeds(orders, lineitem), strict=True))
    for name, feed in made.items():
        for source in registry[name]:
            own = feed.where(F.col("brand") == source.brand).drop("brand")
            (own.withColumnRenamed("batch_runtime", "runtime") if source.brand == "STORE_D" else own).write.parquet(source.location)
        registry[name] = [StoreSource(s.brand, s.location, {"runtime": "batch_runtime"} if s.brand == "STORE_D" else {}) for s in registry[name]]
    stores = {s.brand for s in registry[names[0]]}
    feeds = read_statement_feeds(spark, registry, "Marketplace")
    for name, got in zip(names, feeds, strict=True):
        assert got.count() == made[name].where(F.col("brand").isin(*stores)).count() and {r[0] for r in got.select("brand").distinct().collect()} == stores
    newest = made[names[0]].where("brand = 'STORE_A'").agg(F.max("batch_runtime")).first()[0]
    late = read_statement_feeds(spark, registry, "Marketplace", marks(spark, [("STORE_A", newest), ("STORE_D", 1 << 60)]))
    assert late[0].count() == 1
