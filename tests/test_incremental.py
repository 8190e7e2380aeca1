from datetime import datetime, timedelta

from starmill.functions.labels import FIRST_WATERMARK
from starmill.operators.incremental import (
    advance_watermarks, incremental, last_watermark, latest_batch, next_watermark, tag_batch,
    watermarks)
from starmill.operators.lookup import one_per_key
from starmill.schemas import RUN_LOG

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def frame(spark, data):
    return spark.createDataFrame(data, "id int, ts timestamp_ntz, other timestamp_ntz")


def test_a_row_at_the_watermark_is_not_loaded(spark, rows):
    df = frame(spark, [(1, T0, None), (2, T1, None), (3, T2, None)])
    assert rows(incremental(df, "ts", T1), "id") == [(3,)]


def test_any_of_several_times_counts(spark, rows):
    df = frame(spark, [(1, T0, None), (2, T0, T2), (3, T2, T0)])
    assert rows(incremental(df, ["ts", "other"], T1), "id") == [(2,), (3,)]


def test_lookback_reads_a_span_again(spark, rows):
    df = frame(spark, [(1, T0, None), (2, T1, None)])
    assert rows(incremental(df, "ts", T1, timedelta(hours=1)), "id") == [(2,)]


def test_first_run_loads_everything(spark):
    df = frame(spark, [(1, datetime(1901, 1, 1), None)])
    assert incremental(df, "ts", FIRST_WATERMARK).count() == 1


def log(spark, data):
    return spark.createDataFrame(
        [(p, "b", s, at, at, w, 0, None) for p, s, at, w in data], RUN_LOG)


def test_watermark_survives_a_failed_run(spark):
    runs = log(spark, [("P", "OK", T0, T0), ("P", "ERROR", T1, None), ("Q", "OK", T2, T2)])
    assert last_watermark(runs, "P") == T0
    assert last_watermark(runs, "absent") == FIRST_WATERMARK


def test_watermarks_of_many_processes(spark, rows):
    runs = log(spark, [("P", "OK", T0, T0), ("P", "OK", T1, T1)])
    wanted = spark.createDataFrame([("P",), ("new",)], "process string")
    assert rows(watermarks(runs, wanted)) == [("P", T1), ("new", FIRST_WATERMARK)]


def test_next_watermark_of_a_full_and_an_empty_batch(spark):
    staged = tag_batch(frame(spark, [(1, T0, None), (2, T2, None)]), "b1", T2)
    assert tuple(next_watermark(staged, "ts", T0, "b1").first()) == (T2, 2)
    assert tuple(next_watermark(staged, "ts", T1, "b2").first()) == (T1, 0)


def test_an_empty_batch_keeps_the_watermark_before_it(spark, rows):
    staged = spark.createDataFrame([(1, T0), (1, T1), (3, T2)], "batch_id int, ts timestamp_ntz")
    batches = spark.createDataFrame([(0,), (1,), (2,), (3,)], "batch_id int")
    assert rows(advance_watermarks(staged, batches, "ts", FIRST_WATERMARK)) == [
        (0, FIRST_WATERMARK), (1, T1), (2, T1), (3, T2)]


def test_latest_batch_goes_by_time_not_by_id(spark, rows):
    staged = spark.createDataFrame([(1, "zzz", T0), (2, "aaa", T1), (3, "aaa", T1)],
                                   "id int, batch_id string, loaded_at timestamp_ntz")
    assert rows(latest_batch(staged), "id") == [(2,), (3,)]


def test_one_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, T0, "a"), (1, T1, "b"), (2, T0, None), (3, T0, "x"), (3, T0, "y")],
        "k int, ts timestamp_ntz, v string")
    assert rows(one_per_key(df, ["k"], ["ts"]), "k", "v") == [(1, "b"), (2, None), (3, "y")]
