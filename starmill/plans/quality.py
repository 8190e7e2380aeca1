"""Checks that stand in for declared keys: orphans, duplicates, lost rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starmill.plans.facts import LOOKUPS, Lookup
from starmill.functions.scalars import date_key


def with_presence(lines: DataFrame, dims: Mapping[str, DataFrame],
                  lookups: Sequence[Lookup] = LOOKUPS) -> DataFrame:
    """Add ``_has_<dimension>`` for each lookup: true, or NULL when the member is missing."""
    for lookup in lookups:
        members = dims[lookup.dimension].select(
            F.col(lookup.business_id).alias("_id"), F.lit(True).alias(f"_has_{lookup.dimension}"))
        lines = lines.join(members, lines[lookup.line_column] == F.col("_id"), "left").drop("_id")
    return lines


def fact_orphans(lines: DataFrame, dims: Mapping[str, DataFrame],
                 lookups: Sequence[Lookup] = LOOKUPS) -> DataFrame:
    """Lines whose id a dimension does not hold, per dimension; all counted in one pass.

    A NULL id is not an orphan.
    """
    counts = with_presence(lines, dims, lookups).agg(*[
        F.count_if(F.col(l.line_column).isNotNull() & F.col(f"_has_{l.dimension}").isNull())
        .alias(l.dimension) for l in lookups])
    return counts.unpivot([], [l.dimension for l in lookups], "dimension", "rows")


def fact_key_orphans(fact: DataFrame, dims: Mapping[str, DataFrame],
                     lookups: Sequence[Lookup] = LOOKUPS) -> DataFrame:
    """Stored lines whose surrogate key a dimension does not hold, per dimension.

    The fact is reduced to its distinct keys and their counts for each dimension before the join, so a
    member that very many lines refer to is one row there.
    """
    missing = []
    for lookup in lookups:
        held = fact.where(F.col(lookup.key).isNotNull()).groupBy(lookup.key).agg(F.count("*").alias("_rows"))
        members = dims[lookup.dimension].select(F.col(lookup.key).alias("_member"))
        missing.append(held.join(members, F.col(lookup.key) == F.col("_member"), "left_anti").agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows")).select(
            F.lit(lookup.dimension).alias("dimension"), "rows"))
    return reduce(DataFrame.union, missing)


def duplicates_with(part: DataFrame, earlier: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``part`` that it and ``earlier`` rows hold more than once together, with the number of rows.

    Both have the year an order is stored under. ``earlier`` is read for the years and orders of ``part``.
    """
    order, year = keys[0], "order_year"
    years = [r[0] for r in part.select(year).distinct().collect()]  # years of the calendar
    own = part.groupBy(*keys).agg(F.count("*").alias("rows"))
    orders = part.select(order).distinct()
    before = (earlier.where(F.col(year).isin(years)).join(orders, order, "left_semi")
              .groupBy(*keys).agg(F.count("*").alias("_before")))
    return (own.join(before, list(keys), "left")
            .select(*keys, (F.col("rows") + F.coalesce("_before", F.lit(0))).alias("rows")).where("rows > 1"))


def fact_duplicates(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def reconciliation(detail: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame],
                   lookups: Sequence[Lookup] = LOOKUPS) -> DataFrame:
    """Where each source line went: loaded, or dropped by the first lookup that misses it.

    ``source`` is the sum of all other rows.
    """
    heads = header.withColumn("_has_header", F.lit(True))
    lines = detail.join(heads, "sales_order_id", "left").withColumn("date_key", date_key("order_date"))
    strict = [l for l in lookups if l.on_missing == "drop"]
    reason = F.when(F.col("_has_header").isNull(), "dropped: order header")
    for lookup in strict:
        reason = reason.when(F.col(f"_has_{lookup.dimension}").isNull(),
                             f"dropped: {lookup.dimension}")
    counted = (with_presence(lines, dims, strict)
               .groupBy(reason.otherwise("loaded").alias("reason")).agg(F.count("*").alias("rows")))
    return (counted.rollup("reason").agg(F.sum("rows").cast("long").alias("rows"))
            .select(F.coalesce("reason", F.lit("source")).alias("reason"), "rows"))
