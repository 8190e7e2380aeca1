"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.functions.scalars import date_key


def calendar(spark: SparkSession, start: date = date(2000, 1, 1), end: date = date(2030, 12, 31),
             fiscal_start: int = 7) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included.

    Weeks are ISO weeks and begin on Monday (1). The fiscal year is named after the calendar
    year in which it ends; ``fiscal_start`` is its first month.
    """
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    weekday = (F.weekday("full_date") + 1).cast("int")
    year = F.year("full_date")
    fiscal = year if fiscal_start == 1 else (
        year + F.when(F.month("full_date") >= fiscal_start, 1).otherwise(0))
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.dayofmonth("full_date").cast("int").alias("day"),
        F.weekofyear("full_date").cast("int").alias("iso_week"),
        F.month("full_date").cast("int").alias("month"),
        F.quarter("full_date").cast("int").alias("quarter"),
        year.cast("int").alias("year"),
        weekday.alias("iso_weekday"),
        (weekday >= 6).alias("is_weekend"),
        fiscal.cast("int").alias("fiscal_year"),
    )
