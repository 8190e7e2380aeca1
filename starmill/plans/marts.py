"""Questions asked of the star: totals, series, rankings, and the territory by category mart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.functions.labels import NO_CATEGORY, NO_GROUP
from starmill.operators.history import point_in_time
from starmill.operators.keys import rank_all
from starmill.sources.shared import Scratch

Star = Mapping[str, DataFrame]

def total(column: str) -> Column:
    return F.sum(column).cast("decimal(22,2)")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient at six decimals; NULL for a zero divisor."""
    value = top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    return F.round(value, 6).cast("decimal(18,6)")


def totals(fact: DataFrame) -> DataFrame:
    return fact.agg(total("line_total").alias("sales"), F.sum("order_qty").cast("long").alias("units"))


def average_ticket(fact: DataFrame) -> DataFrame:
    """Sales per distinct order.

    Lines are first summed per order, so the distinct count is a plain count.
    """
    per_order = fact.groupBy("sales_order_id").agg(F.sum("line_total").alias("_sales"))
    summed = per_order.agg(total("_sales").alias("sales"),
                           F.count("*").alias("orders"))
    return summed.select("sales", "orders",
                         ratio(F.col("sales"), F.col("orders")).alias("avg_ticket"))


def daily_sales(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key").agg(F.sum("line_total").alias("_sales"))


def monthly_sales(star: Star) -> DataFrame:
    """Sales per month; the fact is reduced to one row per day before the calendar is joined."""
    days = star["dim_date"].select("date_key", "year", "month")
    return (daily_sales(star["fact_sales"]).join(days, "date_key").groupBy("year", "month")
            .agg(total("_sales").alias("sales")))


def monthly_with_mean(star: Star) -> DataFrame:
    """Monthly series with its mean as a reference line.

    The window holds one row per month of the calendar.
    """
    months = monthly_sales(star)
    everything = Window.partitionBy()
    return months.withColumn(
        "mean", ratio(F.sum("sales").over(everything), F.count("*").over(everything)))


def yoy_growth(star: Star) -> DataFrame:
    """Growth on the year before; NULL for the first year and after a year without sales."""
    years = (daily_sales(star["fact_sales"]).join(star["dim_date"].select("date_key", "year"), "date_key")
             .groupBy("year").agg(total("_sales").alias("sales")))
    by_year = Window.orderBy("year")  # one row per calendar year
    follows = F.lag("year").over(by_year) == F.col("year") - 1
    previous = F.when(follows, F.lag("sales").over(by_year))
    return (years.withColumn("previous", previous)
            .withColumn("growth", ratio(F.col("sales") - F.col("previous"), F.col("previous"))))


def sales_by_salesperson(star: Star) -> DataFrame:
    """Sales per salesperson, those without one included; names are joined after the sums."""
    per_key = star["fact_sales"].groupBy("salesperson_key").agg(total("line_total").alias("sales"))
    names = star["dim_salesperson"].select("salesperson_key", "full_name")
    return per_key.join(names, "salesperson_key").select("salesperson_key", "full_name", "sales")


def salesperson_rank(star: Star, scratch: Scratch | None = None) -> DataFrame:
    return rank_all(sales_by_salesperson(star), "sales", "sales_rank", ["salesperson_key"], scratch)


def sliced_totals(star: Star, year: int, category: str, group: str) -> DataFrame:
    """Totals of one year, category and territory group.

    The year prunes the fact's partitions; the other filters cut the dimensions before they are
    joined.
    """
    lines = in_date_keys(star["fact_sales"], year * 10000 + 101, year * 10000 + 1231)
    products = star["dim_product"].where(F.col("category") == category).select("product_key")
    territories = star["dim_territory"].where(F.col("group_name") == group).select("territory_key")
    lines = lines.join(products, "product_key").join(territories, "territory_key")
    per_order = lines.groupBy("sales_order_id").agg(
        F.sum("line_total").alias("_sales"), F.sum("order_qty").alias("_units"))
    return per_order.agg(total("_sales").alias("sales"),
                         F.sum("_units").cast("long").alias("units"), F.count("*").alias("orders"))


def territory_category(star: Star) -> DataFrame:
    """Sales and distinct orders per territory group and product category, from the star."""
    lines = (star["fact_sales"].select("product_key", "territory_key", "sales_order_id", "line_total")
             .join(star["dim_product"].select("product_key", "category"), "product_key")
             .join(star["dim_territory"].select("territory_key", "group_name"), "territory_key"))
    return _by_group_and_category(lines)


def _by_group_and_category(lines: DataFrame) -> DataFrame:
    per_order = (lines.groupBy("group_name", "category", "sales_order_id")
                 .agg(F.sum("line_total").alias("_sales")))
    return per_order.groupBy("group_name", "category").agg(
        total("_sales").alias("sales"), F.count("*").alias("orders"))


def territory_category_from_sources(src: Star) -> DataFrame:
    """The same answer from the normalised tables: detail, header, product, subcategory,
    category, territory.

    Products grow with the sales and are shuffled, not broadcast. They are met before the header, so that
    the sums per order need no shuffle of their own.
    """
    lines = (
        src["sales_order_detail"]
        .join(src["product"].select("product_id", "product_subcategory_id").hint("shuffle_hash"), "product_id")
        .join(src["product_subcategory"].select("product_subcategory_id", "product_category_id"),
              "product_subcategory_id", "left")
        .join(src["product_category"].select("product_category_id", F.col("name").alias("category")),
              "product_category_id", "left")
        .join(src["sales_order_header"], "sales_order_id")
        .join(src["sales_territory"].select("territory_id", "group_name"), "territory_id"))
    return _by_group_and_category(lines.select(
        F.coalesce("group_name", F.lit(NO_GROUP)).alias("group_name"),
        F.coalesce("category", F.lit(NO_CATEGORY)).alias("category"),
        "sales_order_id", "line_total"))


def sales_at_time_of_sale(lines: DataFrame, history: DataFrame, key: str, ts: str,
                          attribute: str) -> DataFrame:
    """Sales by the value an attribute of ``key`` had when each line was sold.

    ``history`` holds the versions of ``key``; lines outside every version count under NULL.
    """
    placed = point_in_time(lines.select(key, ts, "line_total"), history, [key], ts, [attribute])
    return placed.groupBy(attribute).agg(F.count("*").alias("lines"), total("line_total").alias("sales"))


def in_date_keys(fact: DataFrame, first: int, last: int) -> DataFrame:
    """Lines between two date keys; a fact stored by year is read for those years only."""
    lines = fact.where(F.col("date_key").between(first, last))
    if "order_year" in fact.columns:
        lines = lines.where(F.col("order_year").between(first // 10000, last // 10000))
    return lines


def date_key_range(fact: DataFrame, first: int, last: int) -> DataFrame:
    return (in_date_keys(fact, first, last).groupBy("date_key")
            .agg(F.count("*").alias("lines"), total("line_total").alias("sales")))
