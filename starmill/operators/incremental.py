"""Incremental extraction: watermark filter, watermark bookkeeping, batch tags."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from starmill.functions.labels import FIRST_WATERMARK
from starmill.functions.scalars import time_literal


def incremental(df: DataFrame, ts: str | Sequence[str], last: datetime,
                lookback: timedelta = timedelta(0)) -> DataFrame:
    """Rows modified after ``last``.

    Several time columns mean "any of them is newer", so changes of joined tables count too.
    A ``lookback`` re-reads a span before the watermark to catch rows that arrived late; the
    merge that follows is idempotent, so re-reading is safe. Each test is a plain comparison
    with a literal and reaches the Parquet scan.
    """
    columns = [ts] if isinstance(ts, str) else list(ts)
    bound = time_literal(last - lookback)
    return df.where(reduce(lambda a, b: a | b, [F.col(c) > bound for c in columns]))


def watermarks(log: DataFrame, processes: DataFrame) -> DataFrame:
    """Newest stored watermark of each listed process; the first-run value when there is none."""
    stored = (log.where(F.col("watermark").isNotNull())
              .groupBy("process")
              .agg(F.max_by("watermark", "started_at").alias("watermark")))
    return (processes.join(stored, "process", "left")
            .select("process", F.coalesce("watermark", time_literal(FIRST_WATERMARK)).alias("watermark")))


def last_watermark(log: DataFrame, process: str) -> datetime:
    """The watermark one process starts from."""
    row = (log.where((F.col("process") == process) & F.col("watermark").isNotNull())
           .agg(F.max_by("watermark", "started_at").alias("watermark")).first())
    return row.watermark or FIRST_WATERMARK


def next_watermark(staged: DataFrame, ts: str, last: datetime,
                   batch_id: str | None = None) -> DataFrame:
    """One row: the newest time staged by this batch, never before ``last``, and its rows.

    A batch that re-reads a span before the watermark may hold nothing newer than it.
    """
    if batch_id is not None:
        staged = staged.where(F.col("batch_id") == batch_id)
    return staged.agg(F.greatest(F.max(ts), time_literal(last)).alias("watermark"),
                      F.count("*").alias("rows"))


def advance_watermarks(staged: DataFrame, batches: DataFrame, ts: str, last: datetime) -> DataFrame:
    """The watermark after each batch when ``batches`` are loaded in the order of ``batch_id``.

    A batch that staged nothing keeps the value before it. The running maximum is taken over
    one row per batch.
    """
    newest = staged.groupBy("batch_id").agg(F.max(ts).alias("_newest"))
    so_far = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return batches.join(newest, "batch_id", "left").select(
        "batch_id",
        F.coalesce(F.last("_newest", ignorenulls=True).over(so_far), time_literal(last))
        .alias("watermark"))


def tag_batch(df: DataFrame, batch_id: str, loaded_at: datetime) -> DataFrame:
    return df.withColumns({
        "loaded_at": time_literal(loaded_at),
        "batch_id": F.lit(batch_id),
    })


def latest_batch(staged: DataFrame, batch: str = "batch_id", loaded_at: str = "loaded_at") -> DataFrame:
    """Rows of the batch loaded last.

    Batch ids are random, so the order comes from the load time, never from the ids. The newest
    batch is a scalar subquery and is evaluated once.
    """
    newest = staged.agg(F.max_by(batch, F.struct(loaded_at, batch)))
    return staged.where(F.col(batch) == newest.scalar())
