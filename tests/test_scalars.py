from datetime import date, datetime

from pyspark.sql import functions as F

from starmill.functions import (
    calendar, date_key, default_to, differs, minute_index, null_tolerant_concat, seconds_between)
from starmill.functions.scalars import sql_literal


def test_concat_keeps_the_separator_when_a_part_is_null(spark, rows):
    df = spark.createDataFrame(
        [(1, "A", "B"), (2, None, "X"), (3, "Y", None), (4, None, None)], "id int, a string, b string")
    assert rows(df.select("id", null_tolerant_concat("a", "b"))) == [
        (1, "A B"), (2, " X"), (3, "Y "), (4, " ")]


def test_default_to(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, a string")
    assert rows(df.select("id", default_to("a", "N/A"))) == [(1, "N/A"), (2, "x")]


def test_date_key(spark, rows):
    df = spark.createDataFrame([(datetime(2011, 5, 3, 23, 59),), (datetime(1999, 12, 31),), (None,)],
                               "ts timestamp_ntz")
    assert rows(df.select(date_key("ts"))) == [(19991231,), (20110503,), (None,)]


def test_differs_with_and_without_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", "a"), (2, "a", "b"), (3, None, "b"), (4, "a", None), (5, None, None)],
        "id int, x string, y string")
    x, y = F.col("x"), F.col("y")
    assert rows(df.select("id", differs(x, y), differs(x, y, null_safe=False))) == [
        (1, False, False), (2, True, True), (3, True, False), (4, True, False), (5, False, False)]


def test_seconds_count_boundaries_and_are_null_while_running(spark, rows):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000)),
         (datetime(2024, 1, 1), None)], "a timestamp_ntz, b timestamp_ntz")
    assert rows(df.select(seconds_between("a", "b"))) == [(1,), (None,)]


def test_seconds_ignore_clock_changes(spark, rows):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(df.select(seconds_between("a", "b"), minute_index("b", 60) - minute_index("a", 60))) == [
            (7200, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_minute_index_grows_with_time(spark):
    df = spark.createDataFrame(
        [(datetime(1969, 12, 31, 23, 59),), (datetime(1970, 1, 1),), (datetime(1970, 1, 1, 1, 0),),
         (datetime(2024, 3, 31, 2, 30),), (datetime(2024, 3, 31, 3, 10),)], "ts timestamp_ntz")
    found = [r[0] for r in df.select("ts", minute_index("ts", 60).alias("m")).orderBy("ts").select("m").collect()]
    assert found[:3] == [-1, 0, 1] and found == sorted(found) and len(set(found)) == 5


def test_sql_literal_quotes(spark):
    for text in ["it's", "back\\slash", 'double "quote"', "\\' both"]:
        assert spark.sql(f"select {sql_literal(text)}").first()[0] == text


def test_calendar_has_every_day_once(spark):
    days = calendar(spark)
    assert days.count() == 11323
    assert days.select("date_key").distinct().count() == 11323
    first = days.agg(F.min("full_date"), F.max("full_date")).first()
    assert tuple(first) == (date(2000, 1, 1), date(2030, 12, 31))


def test_calendar_attributes(spark):
    day = {r.date_key: r for r in calendar(spark).where(
        "date_key in (20000101, 20240229, 20240630, 20240701, 20241230, 20241231)").collect()}
    assert day[20240229].day == 29 and day[20240229].quarter == 1 and day[20240229].iso_weekday == 4
    assert day[20000101].is_weekend and day[20000101].iso_week == 52
    assert day[20241230].iso_week == 1  # belongs to the first week of 2025
    assert day[20240630].fiscal_year == 2024 and day[20240701].fiscal_year == 2025
    assert calendar(spark, fiscal_start=1).where("fiscal_year <> year").count() == 0
