"""As-of joins at each fact's own time against brute force."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators.asof import as_of_join
from orderloom.operators.history import FROM, TO

FACTS = "k string, n int, at timestamp_ntz, v string"
HISTORY = "k string, n int, v int, valid_from timestamp_ntz, valid_to timestamp_ntz"
START = dt.datetime(1969, 12, 1)


def hour(n):
    return None if n is None else START + dt.timedelta(hours=n)


@pytest.fixture(scope="module")
def data():
    """A key with most of the rows, NULL keys and times, gaps, rows that end where the next begins, facts before the first row."""
    rnd = random.Random(2)
    keys = [("hot", 1)] * 6 + [("a", 1), ("a", 2), (None, 1), ("b", None), ("gone", 3)]
    history = []
    for key in sorted(set(keys), key=str)[:-1]:
        t = rnd.randrange(100)
        for v in range(60 if key[0] == "hot" else 4):
            end = t + rnd.randrange(1, 60)
            history.append((*key, v, hour(t), hour(end)))
            t = end + (rnd.randrange(30) if rnd.random() < 0.2 else 0)
        history[-1] = (*history[-1][:4], None)
    facts = [(*rnd.choice(keys), hour(rnd.randrange(3000) if rnd.random() < 0.95 else None), f"f{i}") for i in range(600)]
    facts += [(h[0], h[1], h[3], "begin") for h in history[:20]] + [(h[0], h[1], h[4], "end") for h in history[:20]] + facts[:5]
    return facts, history


def brute(facts, history):
    out = Counter()
    for k, n, at, v in facts:
        found = [h[2] for h in history if h[:2] == (k, n) and at is not None and h[3] <= at and (h[4] is None or at < h[4])]
        assert len(found) <= 1
        out[k, n, at, v, found[0] if found else None] += 1
    return out


@pytest.mark.parametrize("days", [1, 30, 100_000])
def test_as_of_join(spark, data, days):
    facts, history = data
    got = as_of_join(spark.createDataFrame(facts, FACTS).repartition(3), spark.createDataFrame(history, HISTORY), ["k", "n"], "at", ["v"], "was_", days)
    assert got.columns == ["k", "n", "at", "v", "was_v"]
    assert Counter(map(tuple, got.collect())) == brute(facts, history)


def test_edges(spark, data):
    facts, history = (spark.createDataFrame(rows, schema) for rows, schema in zip(data, (FACTS, HISTORY), strict=True))
    with pytest.raises(ValueError, match="choose a prefix"):
        as_of_join(facts, history, ["k", "n"], "at", ["v"])
    alone = as_of_join(facts, history.limit(0), ["k", "n"], "at", ["v"], "was_")
    assert alone.count() == facts.count() and alone.where("was_v is not null").count() == 0
    assert as_of_join(facts.limit(0), history, ["k", "n"], "at", ["v"], "was_").count() == 0
    # Rows that begin together: the open one counts.
    twice = spark.createDataFrame([("a", 1, 1, hour(0), hour(5)), ("a", 1, 2, hour(0), None), ("a", 1, 3, hour(0), hour(9))], HISTORY)
    one = spark.createDataFrame([("a", 1, hour(3), "x"), ("a", 1, hour(2000), "y")], FACTS)
    assert {r.was_v for r in as_of_join(one, twice, ["k", "n"], "at", ["v"], "was_").collect()} == {2}


def test_plan_has_no_range_join_and_splits_hot_keys(spark, data):
    facts, history = (spark.createDataFrame(rows, schema) for rows, schema in zip(data, (FACTS, HISTORY), strict=True))
    joined = as_of_join(facts, history, ["k", "n"], "at", ["v"], "was_", 2)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    hot = facts.where("k = 'hot'").select(F.floor(F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', at)") / (2 * 86400)).alias("s"))
    assert hot.groupBy("s").count().agg(F.max("count")).first()[0] * 10 < hot.count()
    assert {FROM, TO} <= set(history.columns)


def test_keys_and_time_of_facts_are_shuffled_once(spark):
    """They come back from the join's own columns, also where a fact has nothing else, and keep the facts' types where those differ."""
    facts = spark.createDataFrame([("a", 1, hour(5)), ("a", 1, hour(1)), (None, 1, hour(9)), ("a", 1, None)], "k string, n int, at timestamp_ntz")
    history = spark.createDataFrame([("a", 1, 7, hour(2), hour(6)), (None, 1, 8, hour(2), None)], HISTORY)
    got = as_of_join(facts, history, ["k", "n"], "at", ["v"])
    assert "fact" not in {f.name for f in got.schema} and got.columns == ["k", "n", "at", "v"]
    assert Counter(map(tuple, got.collect())) == Counter([("a", 1, hour(5), 7), ("a", 1, hour(1), None), (None, 1, hour(9), 8), ("a", 1, None, None)])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct(k" not in plan and "named_struct(begin" not in plan
    wide = as_of_join(facts, history.withColumn("n", F.col("n").cast("bigint")), ["k", "n"], "at", ["v"])
    assert wide.schema["n"].dataType.simpleString() == "int"
    assert Counter(map(tuple, wide.collect())) == Counter(map(tuple, got.collect()))
