import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.attributes import MAP, attribute_columns, attributes_map
from orderloom.operators.dedup import first_and_last, keep_earliest, keep_first, keep_latest, ordering
from orderloom.operators import history
from orderloom.operators.history import scd2_as_of, scd2_current, scd2_merge, scd2_run, scd2_schema, scd2_table
from orderloom.operators.incremental import FLOOR, MARK, high_water, high_water_overall, increment
from orderloom.operators.merge import (
    merge_ranked,
    merge_upsert,
    sync_columns,
    touched_partitions,
    with_bucket,
)
from orderloom.sources.sinks import (
    append_increment,
    conform,
    drop_pii,
    empty,
    read_table,
    replace_partitions,
    with_audit,
    write_table,
)


def plan(df):
    return df._jdf.queryExecution().toString()


VERSIONS = [
    ("A", "1", 1, 10, "old"),
    ("A", "1", 3, 5, "tie, loaded first"),
    ("A", "1", 3, 9, "newest"),
    ("A", "1", None, 99, "no update time"),
    ("B", "1", 2, 1, "other store"),
    (None, "1", 1, 1, "no store"),
    (None, "1", 2, 1, "no store, newer"),
]
SCHEMA = "brand string, id string, upd int, loaded int, note string"


def test_keep_latest(spark, rows):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    assert rows(keep_latest(df, ["brand", "id"], ["upd", "loaded"]), "brand", "note") == [
        (None, "no store, newer"),
        ("A", "newest"),
        ("B", "other store"),
    ]


def test_keep_earliest_and_tie_break(spark, rows):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    dear = [F.col("loaded").desc_nulls_last()]
    assert rows(keep_earliest(df.where("upd = 3 or upd is null"), ["id"], ["upd"], dear), "note") == [("newest",)]


def test_pick_limits_each_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(keep_latest(df, ["k"], ["id"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_first_and_last_match_two_picks(spark, rows):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    first = ordering(F.col("upd"), F.col("loaded"), nulls_last=True)
    last = ordering(F.col("upd"), F.col("loaded"))
    out = first_and_last(df, ["brand", "id"], (["note"], first), (["note"], last))
    assert rows(out.select("brand", "first.note", F.col("last.note").alias("l"))) == [
        (None, "no store", "no store, newer"),
        ("A", "old", "newest"),
        ("B", "other store", "other store"),
    ]


def test_hot_key_pick_equals_brute_force(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"),
        ((F.col("id") * 7919) % n).alias("ts"),
        "id",
    )
    best = {}
    for i in range(n):
        k, ts = (-1 if i % 3 == 0 else i % 500), (i * 7919) % n
        best[k] = max(best.get(k, (-1, -1)), (ts, i))
    got = {r["k"]: (r["ts"], r["id"]) for r in keep_latest(df, ["k"], ["ts", "id"]).collect()}
    assert got == best


SRC = [("A", 1), ("A", 2), ("A", 3), ("B", 1), ("NEW", 1), ("NEW", None), ("A", None), (None, 1)]


@pytest.mark.parametrize("as_join", [False, True])
@pytest.mark.parametrize(
    "inclusive, floor, expected",
    [
        (True, None, [(None, 1), ("A", 2), ("A", 3), ("NEW", None), ("NEW", 1)]),
        (False, None, [(None, 1), ("A", 3), ("NEW", None), ("NEW", 1)]),
        (False, 0, [(None, 1), ("A", 3), ("NEW", 1)]),
        (False, 1, [("A", 3)]),
    ],
)
def test_increment(spark, rows, as_join, inclusive, floor, expected):
    src = spark.createDataFrame(SRC, "brand string, ts int")
    target = spark.createDataFrame([("A", 1), ("A", 2), ("B", 5), ("C", None)], "brand string, ts int")
    marks = high_water(target, "brand", "ts")
    if not as_join:
        marks = {r[0]: r[1] for r in marks.collect()}
    out = increment(src, marks, "brand", "ts", inclusive, floor)
    assert rows(out) == sorted(expected, key=lambda t: [(v is not None, str(v)) for v in t])


def test_increment_first_run_and_empty_target(spark):
    src = spark.createDataFrame(SRC, "brand string, ts int")
    assert increment(src, None, "brand", "ts").count() == len(SRC)
    none = empty(spark, src.schema)
    assert increment(src, high_water(none, "brand", "ts"), "brand", "ts").count() == len(SRC)
    overall = high_water_overall(none.withColumn("ts", F.lit(None).cast("timestamp_ntz")), "ts", FLOOR)
    assert overall.first()[MARK] == FLOOR


def test_marks_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame(
        [("A", dt.datetime(2024, 1, i + 1)) for i in range(9)], "brand string, ts timestamp_ntz"
    ).write.parquet(path)
    src = spark.read.parquet(path)
    out = increment(src, {"A": dt.datetime(2024, 1, 8)}, "brand", "ts")
    assert out.count() == 2
    pushed = plan(out).split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(ts" in pushed


KEYS = ["brand", "id"]


def newest():
    return [F.col("ts").desc_nulls_last(), F.col("v").desc_nulls_last()]


def test_merge_upsert(spark, rows):
    schema = "brand string, id string, ts int, v string"
    target = spark.createDataFrame([("A", "1", 1, "a"), ("A", "2", 1, "b"), (None, "3", 1, "c")], schema)
    updates = spark.createDataFrame(
        [("A", "2", 2, "b2", "x"), ("A", "2", 3, "b3", "x"), (None, "3", 2, "c2", "x"), ("B", "1", 1, "d", "x")],
        schema + ", extra string",
    )
    once = merge_upsert(target, updates, KEYS, newest())
    expected = [(None, "3", 2, "c2", "x"), ("A", "1", 1, "a", None), ("A", "2", 3, "b3", "x"), ("B", "1", 1, "d", "x")]
    assert rows(once) == expected
    assert rows(merge_upsert(once, updates, KEYS, newest())) == expected


def test_merge_ranked_keeps_the_newer_side(spark, rows):
    schema = "brand string, id string, ts int, v string"
    target = spark.createDataFrame([("A", "1", 5, "kept"), ("A", "2", 1, "lost")], schema)
    late = spark.createDataFrame([("A", "1", 3, "late"), ("A", "2", 2, "newer")], schema)
    assert rows(merge_ranked(target, late, KEYS, newest()), "id", "v") == [("1", "kept"), ("2", "newer")]


def test_first_version_loaded_in_steps_equals_full_load(spark, rows):
    schema = "brand string, id string, ts int, v string"
    df = spark.createDataFrame([("A", "1", t, f"v{t}") for t in range(6)] + [("A", "2", 4, "w")], schema)
    oldest = [F.col("ts").asc_nulls_last()]
    full = rows(keep_first(df, KEYS, oldest))
    steps = merge_ranked(keep_first(df.where("ts < 3"), KEYS, oldest), df.where("ts >= 2"), KEYS, oldest)
    assert rows(steps) == full


def test_touched_partitions_prune(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("ts"))
    write_table(with_bucket(df, ["id"], 8), path, ["key_bucket"])
    target = spark.read.parquet(path)
    updates = with_bucket(df.where("id in ('3', '4')"), ["id"], 8)
    part = touched_partitions(target, updates, "key_bucket")
    buckets = {r[0] for r in updates.select("key_bucket").distinct().collect()}
    assert {r[0] for r in part.select("key_bucket").distinct().collect()} == buckets


def test_replace_partitions_leaves_the_others(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([("A", 1), ("B", 1)], "brand string, v int"), path, ["brand"])
    replace_partitions(spark.createDataFrame([("B", 2)], "brand string, v int"), path, ["brand"])
    assert rows(spark.read.parquet(path), "brand", "v") == [("A", 1), ("B", 2)]


def test_append_syncs_schema(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a")], "id int, gone string")
    append_increment(first, path)
    second = spark.createDataFrame([(2, "b")], "id int, added string")
    append_increment(second, path)
    target = T.StructType.fromDDL("id int, added string")
    assert rows(read_table(spark, path, target)) == [(1, None), (2, "b")]
    assert set(read_table(spark, path).columns) == {"id", "gone", "added"}
    synced, _ = sync_columns(first, second)
    assert synced.columns == ["id", "added"]


def test_conform_pii_audit(spark):
    df = spark.createDataFrame([("1", "x", "secret")], "id string, b string, email string")
    out = conform(df, T.StructType.fromDDL("b string, id decimal(38,0), c double"))
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "decimal(38,0)", "double"]
    assert drop_pii(df, ["email", "phone"]).columns == ["id", "b"]
    assert drop_pii(df, ["email"], allow=["email"]).columns == df.columns
    assert with_audit(df, "run-1").first()["run_id"] == "run-1"


def history_of(spark, runs):
    history = None
    for run in runs:
        current = spark.createDataFrame(run, "k string, upd int, v string")
        history = scd2_merge(history, current, ["k"], "upd")
    return history


RUNS = [
    [("a", 1, "a1"), ("b", 1, "b1"), (None, 1, "n1")],
    [("a", 2, "a2"), ("b", 1, "b1 again"), ("c", 5, "c5"), (None, 2, "n2")],
    [("a", 1, "a1 late"), ("c", 6, "c6")],
]


def test_scd2(spark, rows):
    history = history_of(spark, RUNS)
    assert rows(history, "k", "v", "valid_from", "valid_to") == [
        (None, "n1", 1, 2),
        (None, "n2", 2, None),
        ("a", "a1", 1, 2),
        ("a", "a2", 2, None),
        ("b", "b1", 1, None),
        ("c", "c5", 5, 6),
        ("c", "c6", 6, None),
    ]
    assert rows(scd2_current(history), "v") == [("a2",), ("b1",), ("c6",), ("n2",)]
    assert rows(scd2_as_of(history, F.lit(1)), "v") == [("a1",), ("b1",), ("n1",)]
    assert rows(scd2_as_of(history, F.lit(2)), "v") == [("a2",), ("b1",), ("n2",)]


def test_scd2_is_idempotent_with_one_open_row_per_key(spark, rows):
    again = history_of(spark, RUNS + [RUNS[-1]])
    assert rows(again) == rows(history_of(spark, RUNS))
    assert scd2_current(again).groupBy("k").count().where("count > 1").count() == 0


def test_attributes_last_duplicate_of_the_latest_payload_wins(spark, rows):
    df = spark.createDataFrame(
        [
            ("A", "1", 1, '[{"name":"utm_source","value":"old payload"},{"name":"custom1","value":"gone"}]'),
            ("A", "1", 2, '[{"name":"utm_source","value":"first"},{"name":"utm_source","value":"last"},null,'
             '{"name":"orderType","value":7},{"name":null,"value":"x"},{"name":"custom2","value":null}]'),
            ("A", "2", 1, None),
            ("A", "3", 1, "bad"),
            ("B", "1", 1, "[]"),
        ],
        "brand string, order_id string, loaded int, notes string",
    )
    out = attributes_map(df, ["brand", "order_id"], "notes", [F.col("loaded").desc_nulls_last()])
    got = {(r["brand"], r["order_id"]): r[MAP] for r in out.collect()}
    assert got == {("A", "1"): {"utm_source": "last", "orderType": "7"}, ("A", "2"): {}, ("A", "3"): {}, ("B", "1"): {}}
    assert rows(out.where("order_id = '1' and brand = 'A'").select(*attribute_columns()))[0][:4] == (None, "7", None, "last")


def test_scd2_runs_on_a_table(spark, rows, tmp_path):
    """Equal to the runs in one plan; a run that is repeated or broke off changes nothing; earlier runs are refused."""
    path, schema = str(tmp_path / "h"), "k string, upd int, v string"
    runs = [
        [("a", 1, "a1"), ("b", 1, "b1")],
        [("a", 2, "a2"), ("b", 0, "older"), ("c", 1, "c1")],
        [("c", 5, "c5"), (None, 1, "n1")],
    ]
    kept_rows = None
    for number, data in enumerate(runs):
        current = spark.createDataFrame(data, schema)
        kept_rows = scd2_merge(kept_rows, current, ["k"], "upd")
        scd2_run(spark, path, number, current, ["k"], "upd", buckets=4)
        kept = scd2_schema(current.schema, "upd")
        assert rows(scd2_table(spark, path, kept)) == rows(kept_rows)
    scd2_run(spark, path, 2, current, ["k"], "upd", buckets=4)
    spark.createDataFrame([("z", 1, "half", 1, None)], kept).write.parquet(f"{path}/buckets=4/run=3/history_state=open")
    assert rows(scd2_table(spark, path, kept)) == rows(kept_rows)
    with pytest.raises(ValueError, match="comes after"):
        scd2_run(spark, path, 1, current, ["k"], "upd", buckets=4)


def test_history_moves_the_batch_alone(spark, rows, tmp_path):
    """No exchange of the rows that are there, disk below twice the live table, run numbers beyond 32 bits, an empty table, a fixed bucket count."""
    path, schema = str(tmp_path / "h"), "k int, upd int, v string"
    kept = scd2_schema(spark.createDataFrame([], schema).schema, "upd")
    assert scd2_table(spark, path, kept).count() == 0
    for run in (1, 2):
        scd2_run(spark, path, run, spark.createDataFrame([], schema), ["k"], "upd", buckets=4)
        assert scd2_table(spark, path, kept).count() == 0
    for step in range(10):
        current = spark.range(step, 2000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 0 + (step if step else 1)).cast("int").alias("upd"), F.repeat(F.lit("x"), F.lit(100)).alias("v"))
        current = current.where((F.col("k") % 10 == step) | F.lit(step == 0))
        scd2_run(spark, path, 202612041530 + step, current, ["k"], "upd", buckets=4)
    table = scd2_table(spark, path, kept)
    assert scd2_current(table).count() == 2000 and table.count() > 2000
    live = sum(f.stat().st_size for r in [max((tmp_path / "h" / "buckets=4").iterdir(), key=lambda p: p.name)] for f in r.rglob("*.parquet"))
    closed = sum(f.stat().st_size for f in (tmp_path / "h").rglob("*state=closed/*.parquet"))
    disk = sum(f.stat().st_size for f in (tmp_path / "h").rglob("*.parquet"))
    assert disk < 2 * (live + closed)
    with pytest.raises(ValueError, match="has 4 buckets"):
        scd2_run(spark, path, 202612041550, current, ["k"], "upd", buckets=8)
    opened = current.withColumns({"valid_from": F.col("upd"), "valid_to": F.lit(None).cast("int"), history.ID: history.key_id(["k"])})
    with history._bucketed(spark, opened.schema, f"{path}/buckets=4/run=202612041539/history_state=open", 4) as name:
        text = plan(history._rejoin(spark.table(name), opened, "upd")).split("Physical Plan ==")[1]
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in text
    below = text[text.index("SortMergeJoin") :]
    assert "Bucketed: true" in below


def test_append_adds_new_columns(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    append_increment(first, path)
    append_increment(spark.createDataFrame([(2, 0.5)], "k long, w double"), path, first.schema)
    assert rows(read_table(spark, path), "k", "v", "w") == [(1, "a", None), (2, None, 0.5)]


def test_buckets_of_a_history_follow_the_size_of_its_feed(spark, tmp_path, monkeypatch):
    from orderloom import session

    spark.range(20_000).repartition(1).write.parquet(str(tmp_path / "feed"))
    assert history.buckets_for(spark, str(tmp_path / "feed")) == 8
    monkeypatch.setattr(session, "PIECE", 1000)
    assert history.buckets_for(spark, str(tmp_path / "feed")) > 20


def test_history_shuffles_its_batch_alone_and_makes_the_rest_after(spark, tmp_path):
    """The key's text and the times of validity are not shuffled; what is written is packed with zstd."""
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, 1)) for i in range(20)], "k int, at timestamp_ntz")
    opened = history._opened(rows, ["k"], "at", 4)
    shuffled = opened._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert history.ID not in shuffled and history.FROM not in shuffled
    for run in range(2):
        scd2_run(spark, str(tmp_path / "h"), run, rows, ["k"], "at", buckets=4)
    files = list((tmp_path / "h").rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
