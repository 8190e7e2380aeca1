"""Surrogate keys, the unknown member, and ranks over a whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from starmill.functions.labels import UNKNOWN_KEY
from starmill.sources.shared import Scratch

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits


def assign_keys(new: DataFrame, order_by: Sequence[str | Column], key: str, start: int = 0,
                scratch: Scratch | None = None) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the order of ``order_by``.

    Equal to ``start + row_number() over (order by ...)`` but never in one task: the rows are
    range partitioned and sorted, each partition is numbered on its own, and the number of rows
    in earlier partitions is added. The sorted rows are written once, because partition
    contents must be the same when they are counted and when they are numbered. ``order_by``
    must be unique.
    """
    scratch = scratch or Scratch(new.sparkSession, "keys")
    sorted_rows = scratch.table(
        new.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()))
    part = F.shiftright("_slot", _ROW_BITS)
    # One row per partition: the window and the broadcast below are bounded by that number.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sorted_rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")))
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (sorted_rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(*new.columns, (F.lit(start + 1) + F.col("_offset") + row).cast("long").alias(key)))


def max_key(dimension: DataFrame, key: str) -> int:
    """Greatest assigned key; 0 for an empty dimension, whatever unknown member it holds."""
    return max(dimension.agg(F.max(key)).first()[0] or 0, 0)


def with_unknown_member(dimension: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add the seed row given by ``values``, unless a row with the unknown key is present."""
    key = next(c for c, v in values.items() if v == UNKNOWN_KEY)
    schema = StructType([f for f in dimension.schema.fields])
    for field in schema.fields:
        field.nullable = True
    seed = dimension.sparkSession.createDataFrame(
        [tuple(values.get(f.name) for f in schema.fields)], schema)
    missing = seed.join(dimension.where(F.col(key) == UNKNOWN_KEY).select(key), key, "left_anti")
    return dimension.unionByName(missing)


def rank_all(df: DataFrame, by: str, name: str, tie: Sequence[str],
             scratch: Scratch | None = None) -> DataFrame:
    """``rank() over (order by by desc)`` without gathering the rows in one task.

    The rank of a value is the smallest row number among the rows that share it.
    """
    numbered = assign_keys(df, [F.col(by).desc(), *tie], "_n", scratch=scratch)
    # NULL values rank last, like any other value.
    ranks = numbered.groupBy(F.col(by).alias("_value")).agg(F.min("_n").alias(name))
    return (numbered.drop("_n").join(ranks, F.col(by).eqNullSafe(F.col("_value")))
            .select(*df.columns, name))
