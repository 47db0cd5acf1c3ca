"""Uniqueness over a growing table by its membership filter, against a full check."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators import known_keys as K
from orderloom.operators.quality import check_unique
from orderloom.sources import versions as V

KEYS = ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "a int, b string")


@pytest.mark.parametrize("places", [1 << 20, 64, 40_000])
def test_repeats_are_those_of_a_full_check(spark, tmp_path, places):
    """Also where nearly every key agrees with another by chance; NULL parts of keys are values."""
    table, path = str(tmp_path / "t"), str(tmp_path / "f")
    old = [(i, "x") for i in range(300)] + [(None, "x"), (5, None), (None, None)]
    for part in (old[:150], old[150:]):
        V.write(spark, table, frame(spark, part), KEYS, mode="append", buckets=8)
        K.add_keys(spark, path, frame(spark, part), KEYS, places)
    batch = [(i, "x") for i in range(290, 320)] + [(500, "y"), (500, "y"), (None, "x"), (None, "y"), (7, None), (5, None), (None, None), (None, None)]
    K.add_keys(spark, path, frame(spark, old[:20]), KEYS, places)
    whole = frame(spark, old + batch)
    mine = {tuple(r) for r in frame(spark, batch).distinct().collect()}
    want = Counter(tuple(r) for r in check_unique(whole, KEYS).collect() if (r.a, r.b) in mine)
    got = K.check_new_keys(spark, table, path, frame(spark, batch), KEYS, places)
    assert Counter(map(tuple, got.collect())) == want and len(want) == 14
    K.compact(spark, path, places)
    again = K.check_new_keys(spark, table, path, frame(spark, batch), KEYS, places)
    assert Counter(map(tuple, again.collect())) == want
    assert K.maybe_known(spark, path, frame(spark, old), KEYS, places).count() == len(old)
    with pytest.raises(ValueError, match="places, not"):
        K.add_keys(spark, path, frame(spark, batch), KEYS, places * 2)


def test_empty_sides(spark, tmp_path):
    table, path = str(tmp_path / "t"), str(tmp_path / "f")
    batch = frame(spark, [(1, "x"), (1, "x"), (2, "x")])
    assert [tuple(r)[:3] for r in K.check_new_keys(spark, table, path, batch, KEYS).collect()] == [(1, "x", 2)]
    V.write(spark, table, frame(spark, [(2, "x")]), KEYS, mode="append", buckets=4)
    K.add_keys(spark, path, frame(spark, [(2, "x")]), KEYS)
    assert K.check_new_keys(spark, table, path, batch.limit(0), KEYS).count() == 0
    assert K.check_new_keys(spark, table, path, batch, KEYS).count() == 2


def test_a_batch_reads_its_repeats_buckets_only(spark, tmp_path):
    table, path, wide = str(tmp_path / "t"), str(tmp_path / "f"), F.repeat(F.lit("w"), F.lit(50))
    old = spark.range(20_000).select(F.col("id").cast("int").alias("a"), wide.alias("b"))
    V.write(spark, table, old, KEYS, mode="append", buckets=32)
    K.add_keys(spark, path, old, KEYS)
    batch = spark.range(19_998, 20_400).select(F.col("id").cast("int").alias("a"), wide.alias("b"))
    found = K.check_new_keys(spark, table, path, batch, KEYS)
    assert sorted(r.a for r in found.collect()) == [19_998, 19_999]

    def size(df):
        plan = df._jdf.queryExecution().optimizedPlan()
        return sum(int(str(leaf.stats().sizeInBytes())) for leaf in [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())] if "parquet" in leaf.toString())

    read = size(found)
    assert 0 < read < size(check_unique(V.read(spark, table).unionByName(batch), KEYS)) / 5


def test_places_are_shuffled_not_bitmaps(spark):
    """A bitmap has 4 KB however few bits are set; rows of one key each would be shuffled and sorted with one."""
    placed = spark.range(1, 2000, 7).select(F.col("id").alias("place"))
    found = K._bits(placed)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "bitmap_construct_agg" not in plan[plan.index("Exchange") :]
    assert found.agg(F.sum(F.bitmap_count("bitmap"))).first()[0] == placed.count()


def test_places_follow_the_keys():
    assert K.places_for(0) == K.places_for(2000) == 1 << 15
    assert K.places_for(1 << 20) == 1 << 24 and K.places_for((1 << 20) + 1) == 1 << 25
