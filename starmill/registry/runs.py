"""A run log made from the event table: a process per event type, a batch per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmill.functions.labels import OK, RUNNING


def run_log(events: DataFrame) -> DataFrame:
    """Each run starts at its first event and ends at its last, whose time is its watermark.

    The last run of ``error`` is still in progress.
    """
    runs = events.groupBy(F.col("event_type").alias("process"), F.col("ts").cast("date").alias("_day")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("_end"), F.count("*").alias("_rows"))
    last_day = events.agg(F.max(F.col("ts").cast("date"))).scalar()
    unfinished = (F.col("process") == "error") & (F.col("_day") == last_day)
    done = ~unfinished
    return runs.select(
        "process",
        F.col("_day").cast("string").alias("batch_id"),
        F.when(unfinished, RUNNING).otherwise(OK).alias("state"),
        "started_at",
        F.when(done, F.col("_end")).alias("ended_at"),
        F.when(done, F.col("_end")).alias("watermark"),
        F.when(done, F.col("_rows")).alias("rows_affected"),
        F.lit(None).cast("string").alias("message"))
