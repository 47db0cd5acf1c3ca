import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderloom.operators.dedup import keep_first
from orderloom.operators.history import scd2_current, scd2_merge, scd2_schema
from orderloom.streaming import loads

SCHEMA = "k string, upd int, v string"
LOADS = [
    [("a", 1, "a1"), ("b", 1, "b1"), ("a", 2, "a2")],
    [("a", 1, "late"), ("b", 3, "b3"), (None, 1, "n1")],
    [("a", 2, "a2"), ("c", 1, "c1"), ("b", 2, "late too"), (None, 2, "n2")],
]


def newest():
    return [F.col("upd").desc_nulls_last(), F.col("v").desc_nulls_last()]


def arrive(spark, tmp_path, start):
    """Run ``start`` on a stream once after each load has arrived."""
    landing = str(tmp_path / "landing")
    for load in LOADS:
        frame = spark.createDataFrame(load, SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(landing)
        start(loads.read_arrivals(spark, landing, frame.schema, files_per_batch=1)).awaitTermination()


def everything(spark):
    return spark.createDataFrame([r for load in LOADS for r in load], SCHEMA)


def test_append_stream_loads_each_row_once(spark, rows, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    arrive(spark, tmp_path, lambda s: loads.append_stream(s, log, checkpoint))
    assert rows(spark.read.parquet(log)) == rows(everything(spark))


def test_upsert_stream_equals_one_batch(spark, rows, tmp_path):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "checkpoint")
    arrive(spark, tmp_path, lambda s: loads.upsert_stream(s, path, checkpoint, ["k"], newest(), buckets=4))
    got = loads.current_rows(spark, path, everything(spark).schema)
    assert rows(got) == rows(keep_first(everything(spark), ["k"], newest()))


def test_history_stream_equals_batch_runs(spark, rows, tmp_path):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "checkpoint")
    arrive(spark, tmp_path, lambda s: loads.history_stream(s, path, checkpoint, ["k"], "upd", newest(), buckets=4))
    history = None
    for load in LOADS:
        current = keep_first(spark.createDataFrame(load, SCHEMA), ["k"], newest())
        history = scd2_merge(history, current, ["k"], "upd")
    got = loads.current_rows(spark, path, scd2_schema(everything(spark).schema, "upd"))
    assert rows(got) == rows(history)
    assert scd2_current(got).groupBy("k").count().where("count > 1").count() == 0


def test_repeated_batch_changes_nothing(spark, rows, tmp_path):
    """A batch that ran before its checkpoint was written runs again."""
    path = str(tmp_path / "t")
    arrive(spark, tmp_path, lambda s: loads.upsert_stream(s, path, str(tmp_path / "c1"), ["k"], newest(), buckets=4))
    schema = everything(spark).schema
    before = rows(loads.current_rows(spark, path, schema))
    again = loads.read_arrivals(spark, str(tmp_path / "landing"), schema)
    loads.upsert_stream(again, path, str(tmp_path / "c2"), ["k"], newest(), buckets=4).awaitTermination()
    assert rows(loads.current_rows(spark, path, schema)) == before


def test_another_bucket_count_is_refused(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), everything(spark).schema
    arrive(spark, tmp_path, lambda s: loads.upsert_stream(s, path, str(tmp_path / "c1"), ["k"], newest(), buckets=4))
    before = rows(loads.current_rows(spark, path, schema))
    again = loads.read_arrivals(spark, str(tmp_path / "landing"), schema)
    with pytest.raises(StreamingQueryException, match="4 buckets, not 8"):
        loads.upsert_stream(again, path, str(tmp_path / "c2"), ["k"], newest(), buckets=8).awaitTermination()
    assert rows(loads.current_rows(spark, path, schema)) == before


def test_a_version_that_broke_off_is_not_read(spark, rows, tmp_path):
    path, schema = tmp_path / "t", everything(spark).schema
    arrive(spark, tmp_path, lambda s: loads.upsert_stream(s, str(path), str(tmp_path / "c"), ["k"], newest(), buckets=4))
    before = rows(loads.current_rows(spark, str(path), schema))
    versions = sorted((path / "buckets=4").glob("version=*"))
    broken = path / "buckets=4" / f"version={len(versions) + 1}"
    spark.createDataFrame([("a", 9, "half")], SCHEMA).write.parquet(str(broken / "key_bucket=0"))
    assert rows(loads.current_rows(spark, str(path), schema)) == before


def test_guarded_stream_refuses_what_is_older_than_its_stores_mark(spark, rows, tmp_path, monkeypatch):
    """A late row of one store is refused, an as late one of another kept; a batch that is repeated after a failure decides alike."""
    schema = "store string, k int, at int, v string"
    batches = [
        [("a", 1, 10, "a10"), ("a", 2, 20, "a20"), ("b", 1, 5, "b5"), (None, 1, 7, "n7")],
        [("a", 1, 15, "too late"), ("a", 3, 20, "on the mark"), ("b", 1, 15, "b15"), ("new", 1, 1, "new"), ("b", 2, None, "no time"), (None, 2, 6, "n6")],
        [("a", 1, 25, "a25"), ("a", 1, 19, "late again"), ("new", 2, None, "no time"), ("b", 1, 14, "b14")],
    ]
    path, landing, checkpoint = str(tmp_path / "t"), str(tmp_path / "landing"), str(tmp_path / "c")
    order = [F.col("at").desc_nulls_last(), F.col("v").desc_nulls_last()]

    def run(grace=None):
        stream = loads.read_arrivals(spark, landing, spark.createDataFrame([], schema).schema, files_per_batch=1)
        loads.guarded_upsert_stream(stream, path, checkpoint, ["store", "k"], order, "store", "at", grace, buckets=4).awaitTermination()

    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
        if number == 1:
            with monkeypatch.context() as patch:
                here = loads.matching

                def lost(session, pattern):
                    if "/marks/" in pattern:
                        raise OSError("lost")
                    return here(session, pattern)

                # The table, the refused rows and the marks are written, but Spark does not know: the batch comes again.
                patch.setattr(loads, "matching", lost)
                with pytest.raises(StreamingQueryException, match="lost"):
                    run()
            assert (tmp_path / "t" / "marks" / "batch=1" / "_SUCCESS").exists()
        run()
    table = spark.createDataFrame([], schema).schema
    assert rows(loads.refused_rows(spark, path, table), "batch", "store", "v") == [
        (1, None, "n6"), (1, "a", "too late"), (1, "b", "no time"), (2, "a", "late again"), (2, "b", "b14"), (2, "new", "no time"),
    ]
    got = rows(loads.current_rows(spark, path, table), "store", "k", "v")
    assert ("a", 1, "a25") in got and ("new", 1, "new") in got and ("b", 1, "b15") in got and ("a", 3, "on the mark") in got


def test_grace_of_a_guarded_stream(spark, rows, tmp_path):
    schema, path, landing = "store string, at timestamp_ntz", str(tmp_path / "t"), str(tmp_path / "landing")
    for batch in (["2024-01-10"], ["2024-01-09", "2024-01-08 23:00:00"]):
        spark.createDataFrame([("a", t) for t in batch], "store string, at string").select("store", F.col("at").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(landing)
        stream = loads.read_arrivals(spark, landing, spark.createDataFrame([], schema).schema)
        loads.guarded_upsert_stream(stream, path, str(tmp_path / "c"), ["at"], [F.col("at")], "store", "at", "1 day", buckets=2).awaitTermination()
    kind = spark.createDataFrame([], schema).schema
    assert loads.current_rows(spark, path, kind).count() == 2 and loads.refused_rows(spark, path, kind).count() == 1
    assert loads.refused_rows(spark, str(tmp_path / "none"), kind).count() == 0
