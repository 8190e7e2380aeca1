"""Looking at the neighbouring rows of a key when one key may hold much of the table.

A window over a key runs in one task. Keys above ``hot_rows`` rows are therefore taken out and
cut into slices of time: their windows run per (key, slice), and what a slice needs from earlier
or later slices travels as one summary row per slice. All other keys use a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from starmill.functions.scalars import minute_index
from starmill.sources.shared import Scratch

HOT_ROWS = 2_000_000
SLICE_MINUTES = 60


def find_hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None,
                  scratch: Scratch) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None when there are none (or no limit is set).

    Reads only the key columns and reduces them to one row per key before the shuffle. At most
    (rows of ``df`` / ``hot_rows``) keys can be hot, so the result is small enough to broadcast.
    """
    if hot_rows is None:
        return None
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = scratch.table(counts.where(F.col("_rows") > hot_rows).select(*keys))
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, keys: Sequence[str], ts: str, hot: DataFrame,
              minutes: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of hot keys with the ``_slice`` of time they fall into."""
    hot = F.broadcast(hot.toDF(*[f"_hot_{k}" for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]  # the hot key may be NULL
    busy = df.join(hot, same, "left_semi")
    return df.join(hot, same, "left_anti"), busy.withColumn("_slice", minute_index(ts, minutes))


def across_slices(keys: Sequence[str]) -> WindowSpec:
    """Over slice summaries: a key has at most as many rows as there are slices of time."""
    return Window.partitionBy(*keys).orderBy("_slice")


def hand_over(rows: DataFrame, keys: Sequence[str], summary: dict[str, Column],
              across: dict[str, Column]) -> DataFrame:
    """Summarise the slices of ``rows`` and hand results from slice to slice.

    ``summary`` holds aggregates over the rows of a slice, ``across`` window expressions over
    ``across_slices`` that use them; the latter are joined back to the rows. ``rows`` is read
    twice and should be a written table.
    """
    slices = rows.groupBy(*keys, "_slice").agg(*[c.alias(n) for n, c in summary.items()])
    handed = slices.select(*[F.col(c).alias(f"_at_{c}") for c in [*keys, "_slice"]],
                           *[c.alias(n) for n, c in across.items()])
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in [*keys, "_slice"]]
    return rows.join(handed, same, "left").select(*rows.columns, *across)
