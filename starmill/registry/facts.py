"""The fact load and its variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.plans import marts
from starmill.plans.facts import load_fact
from starmill.registry.context import loaded_warehouse, roles, star
from starmill.registry.sql import STAR
from starmill.sources.roles import LINE_ORDER, sales_person

def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dims = roles(spark, sf_dir), loaded_warehouse(spark, sf_dir).dimensions()
    return load_fact(src["sales_order_detail"], src["sales_order_header"], dims,
                     sales_person=sales_person())


def unknown_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_load(spark, sf_dir).groupBy("salesperson_key").agg(F.count("*").alias("lines"))


def idempotent_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact holds the orders before 1999; the load meets all lines again."""
    src, stored = roles(spark, sf_dir), star(spark, sf_dir)
    existing = marts.in_date_keys(stored["fact_sales"], 19000101, 19981231)
    return load_fact(src["sales_order_detail"], src["sales_order_header"], stored, existing=existing,
                     duplicates="first", line_order=LINE_ORDER, sales_person=sales_person())


def datekey_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.date_key_range(star(spark, sf_dir)["fact_sales"], 19980101, 19981231)


QUERIES = {
    "fact_load": fact_load,
    "fact_unknown_fallback": unknown_fallback,
    "fact_idempotent_load": idempotent_load,
    "fact_datekey_range": datekey_range,
}

ORACLE = {
    "fact_load": f"WITH {STAR} SELECT * FROM fact",
    "fact_unknown_fallback": f"""
        WITH {STAR} SELECT salesperson_key, count(*) AS lines FROM fact GROUP BY salesperson_key""",
    "fact_idempotent_load": f"""
        WITH {STAR},
        newer AS (
            SELECT * FROM lines WHERE o_orderdate >= '1999-01-01'
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber,
                l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax, l_returnflag,
                l_linestatus) = 1)
        SELECT date_key, product_key, customer_key, coalesce(salesperson_key, -1) AS salesperson_key,
               territory_key, promotion_key, l_orderkey AS sales_order_id, order_qty, unit_price,
               unit_price_discount, line_total
        FROM newer
        JOIN dim_product p ON l_partkey = p.product_id
        JOIN dim_customer c ON o_custkey = c.customer_id
        LEFT JOIN dim_salesperson s ON seller = s.salesperson_id
        JOIN dim_territory t ON c_nationkey = t.territory_id
        JOIN dim_promotion d ON newer.promotion_id = d.promotion_id""",
    "fact_datekey_range": f"""
        WITH {STAR}
        SELECT date_key, count(*) AS lines, CAST(sum(line_total) AS DECIMAL(22,2)) AS sales
        FROM fact WHERE date_key BETWEEN 19980101 AND 19981231 GROUP BY date_key""",
}
