"""Checks of keys and of lost rows, on dimensions that lack some members."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.functions.calendar import calendar
from starmill.operators.incremental import latest_batch
from starmill.operators.merge import ambiguous_keys
from starmill.plans import quality
from starmill.plans.facts import LOOKUPS, order_lines
from starmill.registry.context import loaded_warehouse, roles, table
from starmill.registry.sql import LINES
from starmill.sources.roles import sales_person


def merge_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that the last day's batch lists with more than one event type."""
    staged = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("ts").cast("date").cast("string").alias("batch_id"),
        F.col("ts").alias("loaded_at"))
    return ambiguous_keys(latest_batch(staged).select("user_id", "event_type").distinct(), ["user_id"])


def incomplete_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star's dimensions without promoted products, without companies, and with a calendar
    that begins in 2000."""
    dims = loaded_warehouse(spark, sf_dir).dimensions()
    return {
        **dims,
        "dim_date": calendar(spark, start=date(2000, 1, 1)),
        "dim_product": dims["dim_product"].where(F.col("category") != "PROMO"),
        "dim_customer": dims["dim_customer"].where(F.col("customer_type") == "PERSONA"),
    }


def fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = roles(spark, sf_dir)
    lines = order_lines(src["sales_order_detail"], src["sales_order_header"], sales_person())
    return quality.fact_orphans(lines, incomplete_dimensions(spark, sf_dir), LOOKUPS)


def fact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fact_duplicates(roles(spark, sf_dir)["sales_order_detail"],
                                   ["sales_order_id", "product_id"])


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = roles(spark, sf_dir)
    return quality.reconciliation(src["sales_order_detail"], src["sales_order_header"],
                                  incomplete_dimensions(spark, sf_dir))


QUERIES = {
    "dq_merge_ambiguous": merge_ambiguous,
    "dq_fact_orphans": fact_orphans,
    "dq_fact_duplicates": fact_duplicates,
    "dq_fact_reconciliation": reconciliation,
}

_CHECKED = f"""
    WITH lines AS ({LINES}),
    checked AS (
        SELECT date_key < 20000101 AS no_date,
               p_brand <> 'Brand#1' AND p_type = 'PROMO' AS no_product,
               o_custkey NOT IN (SELECT user_id FROM events) AS no_customer
        FROM lines JOIN part ON l_partkey = p_partkey)"""

ORACLE = {
    "dq_merge_ambiguous": """
        SELECT user_id, count(DISTINCT event_type) AS rows FROM events
        WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)
        GROUP BY user_id HAVING count(DISTINCT event_type) > 1""",
    "dq_fact_orphans": _CHECKED + """
        SELECT 'dim_date' AS dimension, count(*) FILTER (no_date) AS rows FROM checked
        UNION ALL SELECT 'dim_product', count(*) FILTER (no_product) FROM checked
        UNION ALL SELECT 'dim_customer', count(*) FILTER (no_customer) FROM checked
        UNION ALL SELECT 'dim_salesperson', 0
        UNION ALL SELECT 'dim_territory', 0
        UNION ALL SELECT 'dim_promotion', 0""",
    "dq_fact_duplicates": """
        SELECT l_orderkey AS sales_order_id, l_partkey AS product_id, count(*) AS rows
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dq_fact_reconciliation": _CHECKED + """
        SELECT CASE WHEN no_date THEN 'dropped: dim_date' WHEN no_product THEN 'dropped: dim_product'
                    WHEN no_customer THEN 'dropped: dim_customer' ELSE 'loaded' END AS reason,
               count(*) AS rows
        FROM checked GROUP BY 1
        UNION ALL SELECT 'source', count(*) FROM lineitem""",
}
