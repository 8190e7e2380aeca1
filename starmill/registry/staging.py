"""Incremental extraction and staging."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.functions.labels import FIRST_WATERMARK, NO_JOB
from starmill.functions.scalars import date_key, default_to, null_tolerant_concat
from starmill.operators.incremental import (
    advance_watermarks, incremental, latest_batch, tag_batch, watermarks)
from starmill.operators.lookup import one_per_key
from starmill.plans import extracts
from starmill.registry.context import LOADED_AT, roles, table, tables
from starmill.registry.runs import run_log
from starmill.sources.shared import fresh_dir
from starmill.sources.store import Store


def stored_watermark(orders: DataFrame) -> datetime:
    """The watermark a load that ran at the turn of 2000 left behind."""
    seen = orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return seen.agg(F.max("o_orderdate")).first()[0] or FIRST_WATERMARK


def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return incremental(orders, "o_orderdate", stored_watermark(orders)).select(
        "o_orderkey", "o_orderdate")


def watermark_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = run_log(table(spark, sf_dir, "events"))
    known = log.select("process").distinct()
    never_run = spark.range(1).select(F.lit("refund").alias("process"))
    return watermarks(log, known.unionByName(never_run))


def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("int").alias("batch_id"), "o_orderdate")
    # One batch per year, and one more that staged nothing.
    span = orders.agg(F.min("batch_id").alias("a"), F.max("batch_id").alias("b"))
    batches = span.select(F.explode(F.sequence("a", F.col("b") + 1)).alias("batch_id"))
    return advance_watermarks(orders, batches, "o_orderdate", FIRST_WATERMARK)


def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    store = Store(spark, fresh_dir(spark, "staging"))
    last = stored_watermark(orders)
    store.write("stg/orders", incremental(orders, "o_orderdate", FIRST_WATERMARK))
    store.write("stg/orders", incremental(orders, "o_orderdate", last))
    return store.read("stg/orders")


def batch_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_batch(table(spark, sf_dir, "customer").select("c_custkey"), "batch-1", LOADED_AT)


def _extract(entity: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return extracts.EXTRACTS[entity](roles(spark, sf_dir), FIRST_WATERMARK).drop("modified_date")
    return run


def last_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ids that do not sort by time, as random ids do not.
    staged = table(spark, sf_dir, "events").select(
        "event_id", F.md5(F.col("ts").cast("date").cast("string")).alias("batch_id"),
        F.col("ts").alias("loaded_at"))
    return latest_batch(staged).select("event_id", "batch_id")


def lookup_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return one_per_key(events, ["user_id"], ["ts"]).select("user_id", "event_id", "event_type")


def concat_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    customers = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(
        t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return customers.select("c_custkey", null_tolerant_concat(
        F.nullif("n_name", F.lit("NATION_3")), F.nullif("r_name", F.lit("ASIA"))).alias("label"))


def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = roles(spark, sf_dir)
    people = src["sales_person"].join(src["employee"], "business_entity_id")
    return people.select(
        F.col("business_entity_id").alias("salesperson_id"),
        default_to("job_title", NO_JOB).alias("job_title"),
        default_to("territory_id", -1).cast("long").alias("territory_id"))


def order_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_key("o_orderdate").alias("date_key"))


QUERIES = {
    "stg_incremental_filter": incremental_filter,
    "stg_watermark_read": watermark_read,
    "stg_watermark_advance": watermark_advance,
    "stg_overwrite_roundtrip": overwrite_roundtrip,
    "stg_batch_tag": batch_tag,
    "stg_extract_customer": _extract("customer"),
    "stg_extract_product": _extract("product"),
    "stg_extract_salesperson": _extract("salesperson"),
    "stg_extract_promotion": _extract("promotion"),
    "stg_extract_territory": _extract("territory"),
    "stg_latest_batch": last_batch,
    "stg_lookup_one_per_key": lookup_one_per_key,
    "expr_null_tolerant_concat": concat_labels,
    "expr_null_defaults": null_defaults,
    "expr_date_key": order_date_key,
}

_NEWER = """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < '2000-01-01')"""

ORACLE = {
    "stg_incremental_filter": _NEWER,
    "stg_watermark_read": """
        SELECT event_type AS process, max(ts) AS watermark FROM events
        WHERE event_type <> 'error' OR CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events)
        GROUP BY event_type
        UNION ALL SELECT 'refund', TIMESTAMP '1900-01-01 00:00:00'""",
    "stg_watermark_advance": """
        WITH span AS (SELECT min(year(o_orderdate)) a, max(year(o_orderdate)) + 1 b FROM orders),
             batches AS (SELECT unnest(range(a, b + 1)) AS y FROM span)
        SELECT CAST(y AS INTEGER) AS batch_id,
               coalesce(max(o_orderdate), (SELECT max(o_orderdate) FROM orders WHERE year(o_orderdate) < y),
                        TIMESTAMP '1900-01-01 00:00:00') AS watermark
        FROM batches LEFT JOIN orders ON year(o_orderdate) = y GROUP BY y""",
    "stg_overwrite_roundtrip": _NEWER,
    "stg_batch_tag": """
        SELECT c_custkey, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at, 'batch-1' AS batch_id
        FROM customer""",
    "stg_extract_customer": """
        WITH users AS (SELECT DISTINCT user_id FROM events),
        latest AS (
            SELECT user_id, event_type, event_id FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
        SELECT c_custkey AS customer_id, u.user_id AS person_id,
               CASE WHEN u.user_id IS NOT NULL THEN 'PERSONA' ELSE 'EMPRESA' END AS customer_type,
               concat(CASE WHEN u.user_id IS NOT NULL AND c_acctbal >= 0 THEN split_part(c_name, '#', 1) END,
                      ' ', CASE WHEN u.user_id IS NOT NULL THEN split_part(c_name, '#', 2) END) AS full_name,
               'user' || e.event_id || '@example.com' AS email,
               '555-' || p.event_id AS phone,
               CASE WHEN l.event_id IS NOT NULL THEN 'City ' || c_custkey END AS city,
               CASE WHEN l.event_id IS NOT NULL THEN n_name END AS state_province,
               CASE WHEN l.event_id IS NOT NULL THEN r_name END AS country,
               CAST(c_nationkey AS BIGINT) AS territory_id
        FROM customer LEFT JOIN users u ON c_custkey = u.user_id
        LEFT JOIN latest e ON e.user_id = u.user_id AND e.event_type = 'signup'
        LEFT JOIN latest p ON p.user_id = u.user_id AND p.event_type = 'click'
        LEFT JOIN latest l ON l.user_id = u.user_id AND l.event_type = 'purchase'
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "stg_extract_product": """
        WITH shipped AS (SELECT l_partkey, min(l_shipdate) a, max(l_shipdate) b FROM lineitem GROUP BY 1)
        SELECT p_partkey AS product_id, p_name AS product_name, 'PN-' || p_partkey AS product_number,
               coalesce(nullif(split_part(p_name, ' ', 1), 'small'), 'N/A') AS color,
               CAST(p_size AS VARCHAR) AS size,
               CAST(p_size * CAST(1.5 AS DECIMAL(3,2)) AS DECIMAL(8,2)) AS weight,
               CASE WHEN p_brand <> 'Brand#1' THEN p_brand ELSE 'Sin SubCategoria' END AS subcategory,
               CASE WHEN p_brand <> 'Brand#1' AND p_type <> 'SMALL' THEN p_type
                    ELSE 'Sin Categoria' END AS category,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(10,2))
                   AS standard_cost,
               CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
               CAST(a AS DATE) AS sell_start_date,
               CASE WHEN p_size > 40 THEN CAST(b AS DATE) END AS sell_end_date
        FROM part LEFT JOIN shipped ON p_partkey = l_partkey""",
    "stg_extract_salesperson": """
        WITH sold AS (SELECT l_suppkey, min(l_shipdate) a FROM lineitem GROUP BY 1)
        SELECT s_suppkey AS salesperson_id,
               concat(split_part(s_name, '#', 1), ' ', split_part(s_name, '#', 2)) AS full_name,
               CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 5000 THEN 'REP' ELSE 'MANAGER' END
                   AS job_title,
               CAST(a AS DATE) AS hire_date,
               CAST(n_nationkey AS BIGINT) AS territory_id, n_name AS territory_name,
               CAST(CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS DECIMAL(19,4)) AS sales_quota,
               CAST(s_acctbal AS DECIMAL(19,4)) AS bonus, CAST(0.01 AS DECIMAL(5,2)) AS commission_pct
        FROM supplier JOIN sold ON s_suppkey = l_suppkey
        LEFT JOIN nation ON nullif(s_nationkey, 0) = n_nationkey""",
    "stg_extract_promotion": """
        SELECT CAST(round(l_discount * 100) AS BIGINT) AS promotion_id,
               'Discount ' || CAST(round(l_discount * 100) AS BIGINT) || '%' AS promotion_name,
               CAST(CAST(round(l_discount * 100) AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(5,4)) AS discount_pct,
               CASE WHEN round(l_discount * 100) = 0 THEN 'No Discount' ELSE 'Volume Discount' END
                   AS promotion_type,
               'Customer' AS category,
               CAST(min(l_shipdate) AS DATE) AS start_date, CAST(max(l_shipdate) AS DATE) AS end_date,
               CAST(min(l_quantity) AS INTEGER) AS min_qty, CAST(max(l_quantity) AS INTEGER) AS max_qty
        FROM lineitem GROUP BY round(l_discount * 100)""",
    "stg_extract_territory": """
        SELECT CAST(n_nationkey AS BIGINT) AS territory_id, n_name AS territory_name,
               n_name AS country_name, r_name AS group_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "stg_latest_batch": """
        SELECT event_id, md5(CAST(CAST(ts AS DATE) AS VARCHAR)) AS batch_id FROM events
        WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)""",
    "stg_lookup_one_per_key": """
        SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "expr_null_tolerant_concat": """
        SELECT c_custkey, concat(nullif(n_name, 'NATION_3'), ' ', nullif(r_name, 'ASIA')) AS label
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "expr_null_defaults": """
        SELECT s_suppkey AS salesperson_id,
               CASE WHEN s_acctbal < 0 THEN 'Sin carga' WHEN s_acctbal < 5000 THEN 'REP'
                    ELSE 'MANAGER' END AS job_title,
               CAST(coalesce(nullif(s_nationkey, 0), -1) AS BIGINT) AS territory_id
        FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)""",
    "expr_date_key": """
        SELECT o_orderkey,
               CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)
                   AS date_key
        FROM orders""",
}
