"""KPIs on the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.plans import marts
from starmill.registry.context import roles, star
from starmill.registry.sql import STAR, ratio


def _on_star(query, *args):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(star(spark, sf_dir), *args)
    return run


def _on_fact(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(star(spark, sf_dir)["fact_sales"])
    return run


def _from_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.territory_category_from_sources(roles(spark, sf_dir))


QUERIES = {
    "kpi_totals": _on_fact(marts.totals),
    "kpi_avg_ticket": _on_fact(marts.average_ticket),
    "kpi_monthly_sales": _on_star(marts.monthly_sales),
    "kpi_monthly_with_mean": _on_star(marts.monthly_with_mean),
    "kpi_sales_by_salesperson": _on_star(marts.sales_by_salesperson),
    "kpi_salesperson_rank": _on_star(marts.salesperson_rank),
    "kpi_yoy_growth": _on_star(marts.yoy_growth),
    "kpi_sliced": _on_star(marts.sliced_totals, 1998, "PROMO", "ASIA"),
    "mart_territory_category": _on_star(marts.territory_category),
    "oltp_territory_category": _from_sources,
}

_SUM = "CAST(sum(line_total) AS DECIMAL(22,2))"
_MONTHS = f"""
    WITH {STAR}, months AS (
        SELECT CAST(date_key // 10000 AS INTEGER) AS year,
               CAST(date_key // 100 % 100 AS INTEGER) AS month, {_SUM} AS sales
        FROM fact GROUP BY 1, 2)"""
_PEOPLE = f"""
    WITH {STAR}, people AS (
        SELECT salesperson_key, full_name FROM dim_salesperson
        UNION ALL SELECT -1, 'VENTA POR INTERNET / SIN VENDEDOR'),
    per_person AS (
        SELECT salesperson_key, full_name, {_SUM} AS sales
        FROM fact JOIN people USING (salesperson_key) GROUP BY ALL)"""
_GROUPS = f"""
    WITH {STAR}
    SELECT group_name, category, {_SUM} AS sales, count(DISTINCT sales_order_id) AS orders
    FROM fact JOIN dim_product USING (product_key) JOIN dim_territory USING (territory_key)
    GROUP BY group_name, category"""

ORACLE = {
    "kpi_totals": f"""
        WITH {STAR} SELECT {_SUM} AS sales, CAST(sum(order_qty) AS BIGINT) AS units FROM fact""",
    "kpi_avg_ticket": f"""
        WITH {STAR}
        SELECT {_SUM} AS sales, count(DISTINCT sales_order_id) AS orders,
               {ratio(_SUM, 'count(DISTINCT sales_order_id)')} AS avg_ticket FROM fact""",
    "kpi_monthly_sales": _MONTHS + " SELECT * FROM months",
    "kpi_monthly_with_mean": _MONTHS + f"""
        SELECT *, (SELECT {ratio('sum(sales)', 'count(*)')} FROM months) AS mean FROM months""",
    "kpi_sales_by_salesperson": _PEOPLE + " SELECT * FROM per_person",
    "kpi_salesperson_rank": _PEOPLE + """
        SELECT *, rank() OVER (ORDER BY sales DESC) AS sales_rank FROM per_person""",
    "kpi_yoy_growth": f"""
        WITH {STAR}, years AS (
            SELECT CAST(date_key // 10000 AS INTEGER) AS year, {_SUM} AS sales FROM fact GROUP BY 1)
        SELECT a.year, a.sales, b.sales AS previous, {ratio('a.sales - b.sales', 'b.sales')} AS growth
        FROM years a LEFT JOIN years b ON a.year = b.year + 1""",
    "kpi_sliced": f"""
        WITH {STAR}
        SELECT {_SUM} AS sales, CAST(sum(order_qty) AS BIGINT) AS units,
               count(DISTINCT sales_order_id) AS orders
        FROM fact JOIN dim_product USING (product_key) JOIN dim_territory USING (territory_key)
        WHERE date_key BETWEEN 19980101 AND 19981231 AND category = 'PROMO' AND group_name = 'ASIA'""",
    "mart_territory_category": _GROUPS,
    "oltp_territory_category": f"""
        WITH lines AS (
            SELECT l_orderkey, r_name AS group_name,
                   CASE WHEN p_brand <> 'Brand#1' AND p_type <> 'SMALL' THEN p_type
                        ELSE 'Sin Categoria' END AS category,
                   CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                        * (CAST(1 AS DECIMAL(5,2)) - CAST(l_discount AS DECIMAL(5,2)))
                        AS DECIMAL(12,2)) AS line_total
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            JOIN part ON l_partkey = p_partkey)
        SELECT group_name, category, {_SUM} AS sales, count(DISTINCT l_orderkey) AS orders
        FROM lines GROUP BY group_name, category""",
}
