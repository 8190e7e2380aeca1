"""Calendar, keys and type 1 merges.

The merges need a dimension that already exists. It is what the same load would have made of the
source as it was at an earlier time, so inserts, updates and kept rows come from the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.functions.calendar import calendar
from starmill.functions.scalars import date_key
from starmill.operators.incremental import latest_batch
from starmill.operators.keys import assign_keys, with_unknown_member
from starmill.operators.lookup import one_per_key
from starmill.operators.merge import action_counts, change_flags, scd1_merge
from starmill.plans.dimensions import DIMENSIONS, UNKNOWN_SALESPERSON, merge_dimension
from starmill.registry.context import (
    CALENDAR_END, CALENDAR_START, LOADED_AT, LOAD_USER, roles, table, tables)
from starmill.schemas import WAREHOUSE
from starmill.sources.roles import promotion_id
from starmill.sources.shared import Scratch

STAMPS = {"loaded_at": LOADED_AT, "load_user": LOAD_USER}


def _until(df: DataFrame, ts: str, day: str) -> DataFrame:
    return df.where(F.col(ts) <= F.lit(day).cast("timestamp_ntz"))


def _after(df: DataFrame, ts: str, day: str) -> DataFrame:
    return df.where(F.col(ts) > F.lit(day).cast("timestamp_ntz"))


def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the calendar with its number of orders, days without orders included."""
    per_day = (table(spark, sf_dir, "orders").groupBy(date_key("o_orderdate").alias("date_key"))
               .agg(F.count("*").alias("_orders")))
    days = calendar(spark, CALENDAR_START, CALENDAR_END)
    return days.join(per_day, "date_key", "left").select(
        *days.columns, F.coalesce("_orders", F.lit(0)).cast("long").alias("orders"))


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return assign_keys(parts, ["p_name", "p_partkey"], "part_key", start=1000).select(
        "p_partkey", "part_key")


def unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = roles(spark, sf_dir)["seller"].select(
        (F.col("business_entity_id") + 1).alias("salesperson_key"),
        F.col("business_entity_id").alias("salesperson_id_source"),
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        F.lit("REP").alias("job_title"))
    return with_unknown_member(people, UNKNOWN_SALESPERSON)


# -- customer: the priority of the latest order is the attribute that changes ------------------

_CUSTOMER_CUT = "1996-06-30"


def _latest_priority(orders: DataFrame) -> DataFrame:
    latest = one_per_key(orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"),
                         ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.select("o_custkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"))


def _customers_at(t: Mapping[str, DataFrame], orders: DataFrame) -> DataFrame:
    return t["customer"].join(_latest_priority(orders), F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), "priority")


def customer_merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as known at the cut, and those that ordered after it."""
    t = tables(spark, sf_dir)
    known = _customers_at(t, _until(t["orders"], "o_orderdate", _CUSTOMER_CUT)).withColumns(
        {"loaded_at": F.lit(_CUSTOMER_CUT).cast("timestamp_ntz"), "load_user": F.lit("first")})
    staged = _customers_at(t, _after(t["orders"], "o_orderdate", _CUSTOMER_CUT))
    stored = Scratch(spark, "merge")
    return stored.table(known), stored.table(staged)


def merge_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = customer_merge_inputs(spark, sf_dir)
    return scd1_merge(target, source, ["customer_id"], ["segment", "priority"], stamps=STAMPS).table


def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_counts(merge_customer(spark, sf_dir))


def change_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = customer_merge_inputs(spark, sf_dir)
    return change_flags(target, source, ["customer_id"], ["segment", "priority"])


def source_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return (t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
            .select("c_custkey", "c_nationkey").distinct())


# -- the other dimensions ----------------------------------------------------------------------

def _merged(spark: SparkSession, name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Load ``before`` into an empty dimension, then merge ``after``."""
    dim, schema, stored = DIMENSIONS[name], WAREHOUSE[name], Scratch(spark, name)
    empty = spark.createDataFrame([], schema)
    first = merge_dimension(dim, empty, dim.source(before), STAMPS, stored, broadcast_source=False)
    source = stored.table(dim.source(after))
    merged = merge_dimension(dim, stored.table(first.drop("action")), source, STAMPS, stored)
    return merged.select(dim.key, dim.business_id, *dim.attributes, "action")


def merge_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territories with orders on the first days are known, some under an older group name."""
    t = tables(spark, sf_dir)
    now = roles(spark, sf_dir)["sales_territory"].select(
        "territory_id", F.col("name").alias("territory_name"), F.col("country").alias("country_name"),
        "group_name")
    early = _until(t["orders"], "o_orderdate", "1995-01-02").join(
        t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    older = F.when(F.col("group_name") == "ASIA", "APAC").when(
        F.col("group_name") != "EUROPE", F.col("group_name"))
    before = (now.join(early, F.col("territory_id") == F.col("c_nationkey"), "left_semi")
              .withColumn("group_name", older))
    return _merged(spark, "dim_territory", before, now)


def sellers_at(t: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """Job and territory follow the latest line a supplier shipped, per ``batch_id``."""
    latest = one_per_key(
        lines.select("batch_id", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                     "l_returnflag", "l_linestatus"),
        ["batch_id", "l_suppkey"],
        ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"])
    return latest.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("salesperson_id"), F.col("s_name").alias("full_name"),
        F.when(F.col("l_returnflag") == "A", "REP").when(F.col("l_returnflag") == "R", "MANAGER")
        .alias("job_title"),
        F.when(F.col("l_linestatus") == "O", F.col("s_nationkey").cast("long")).alias("territory_id"),
        "batch_id", F.col("l_shipdate").alias("loaded_at"))


def merge_salesperson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging holds one batch per shipping year; the merge takes the latest."""
    t = tables(spark, sf_dir)
    lines = t["lineitem"].withColumn("batch_id", F.year("l_shipdate").cast("string"))
    before = sellers_at(t, _until(lines, "l_shipdate", "1995-01-05"))
    staged = Scratch(spark, "staged").table(sellers_at(t, lines))
    after = latest_batch(staged)
    return _merged(spark, "dim_salesperson", before, after)


def _products_at(t: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """A part whose latest line was returned has been taken out of its category."""
    latest = one_per_key(
        lines.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"),
        ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"])
    return latest.join(t["part"], F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.split("p_name", " ")[0].alias("color"), F.col("p_brand").alias("subcategory"),
        F.when(F.col("l_returnflag") != "R", F.col("p_type")).alias("category"))


def merge_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    before = _products_at(t, _until(t["lineitem"], "l_shipdate", "1995-03-01"))
    after = _products_at(t, _after(t["lineitem"], "l_shipdate", "1995-03-01"))
    return _merged(spark, "dim_product", before, after)


def _promotions_at(lines: DataFrame) -> DataFrame:
    dates = lines.groupBy(promotion_id().alias("promotion_id")).agg(
        F.min("l_shipdate").cast("date").alias("start_date"),
        F.max("l_shipdate").cast("date").alias("end_date"))
    return dates.select(
        "promotion_id", F.concat(F.lit("Discount "), F.col("promotion_id").cast("string")).alias("promotion_name"),
        F.lit("Volume Discount").alias("promotion_type"),
        (F.col("promotion_id").cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(5,4)").alias("discount_pct"),
        "start_date", "end_date")


def merge_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return _merged(spark, "dim_promotion", _promotions_at(_until(lines, "l_shipdate", "1995-01-03")),
                   _promotions_at(lines))


QUERIES = {
    "dim_calendar": dim_calendar,
    "dim_surrogate_keys": surrogate_keys,
    "dim_unknown_member": unknown_member,
    "scd1_merge_customer": merge_customer,
    "scd1_merge_counts": merge_counts,
    "scd1_change_detection": change_detection,
    "scd1_source_distinct": source_distinct,
    "scd1_dim_territory": merge_territory,
    "scd1_dim_salesperson": merge_salesperson,
    "scd1_dim_product": merge_product,
    "scd1_dim_promotion": merge_promotion,
}

_CUSTOMERS = """
    WITH known AS (
        SELECT o_custkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders
        WHERE o_orderdate <= '1996-06-30'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    later AS (
        SELECT o_custkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders
        WHERE o_orderdate > '1996-06-30'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""

_MERGED_CUSTOMERS = _CUSTOMERS + """,
    merged AS (
        SELECT c_custkey AS customer_id, c_mktsegment AS segment,
               CASE WHEN l.o_custkey IS NOT NULL THEN l.priority ELSE k.priority END AS priority,
               CASE WHEN k.o_custkey IS NULL THEN 'insert'
                    WHEN l.o_custkey IS NOT NULL AND l.priority IS DISTINCT FROM k.priority THEN 'update'
                    ELSE 'keep' END AS action
        FROM customer LEFT JOIN known k ON c_custkey = k.o_custkey
        LEFT JOIN later l ON c_custkey = l.o_custkey
        WHERE k.o_custkey IS NOT NULL OR l.o_custkey IS NOT NULL)"""


def _merge_sql(before: str, after: str, id_source: str, staged_id: str, key: str,
               attributes: dict[str, str]) -> str:
    """Merge of two tables written out: keys by id within each load, NULL-safe comparison."""
    changed = " OR ".join(f"b.{s} IS DISTINCT FROM a.{s}" for s in attributes.values())
    values = ", ".join(f"CASE WHEN a.{staged_id} IS NULL THEN b.{s} ELSE a.{s} END AS {t}"
                       for t, s in attributes.items())
    return f"""
    WITH before AS ({before}), after AS ({after}),
    old AS (SELECT *, row_number() OVER (ORDER BY {staged_id}) AS k FROM before),
    fresh AS (
        SELECT {staged_id} AS id, row_number() OVER (ORDER BY {staged_id})
               + (SELECT count(*) FROM before) AS k
        FROM after WHERE {staged_id} NOT IN (SELECT {staged_id} FROM before))
    SELECT coalesce(b.k, f.k) AS {key}, coalesce(b.{staged_id}, a.{staged_id}) AS {id_source}, {values},
           CASE WHEN b.{staged_id} IS NULL THEN 'insert'
                WHEN a.{staged_id} IS NOT NULL AND ({changed}) THEN 'update' ELSE 'keep' END AS action
    FROM old b FULL JOIN after a ON b.{staged_id} = a.{staged_id}
    LEFT JOIN fresh f ON f.id = a.{staged_id}"""


def _dimension_sql(name: str, before: str, after: str) -> str:
    dim = DIMENSIONS[name]
    return _merge_sql(before, after, dim.business_id, dim.staged_id, dim.key, dict(dim.attributes))


_TERRITORIES = """
    SELECT CAST(n_nationkey AS BIGINT) AS territory_id, n_name AS territory_name,
           n_name AS country_name, {group} AS group_name
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE {condition}"""

_SELLERS = """
    SELECT s_suppkey AS salesperson_id, s_name AS full_name,
           CASE l_returnflag WHEN 'A' THEN 'REP' WHEN 'R' THEN 'MANAGER' ELSE 'Sin carga' END AS job_title,
           CASE WHEN l_linestatus = 'O' THEN CAST(s_nationkey AS BIGINT) END AS territory_id
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE {condition}
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC,
        l_linenumber DESC, l_partkey DESC, l_returnflag DESC, l_linestatus DESC) = 1"""

_PRODUCTS = """
    SELECT p_partkey AS product_id, p_name AS product_name, split_part(p_name, ' ', 1) AS color,
           p_brand AS subcategory, CASE WHEN l_returnflag <> 'R' THEN p_type END AS category
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {condition}
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
        l_linenumber DESC, l_suppkey DESC, l_returnflag DESC) = 1"""

_PROMOTIONS = """
    SELECT CAST(round(l_discount * 100) AS BIGINT) AS promotion_id,
           'Discount ' || CAST(round(l_discount * 100) AS BIGINT) AS promotion_name,
           'Volume Discount' AS promotion_type,
           CAST(CAST(round(l_discount * 100) AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))
                AS DECIMAL(5,4)) AS discount_pct,
           CAST(min(l_shipdate) AS DATE) AS start_date, CAST(max(l_shipdate) AS DATE) AS end_date
    FROM lineitem WHERE {condition} GROUP BY round(l_discount * 100)"""

ORACLE = {
    "dim_calendar": """
        WITH days AS (
            SELECT CAST(d AS DATE) AS full_date
            FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)),
        per_day AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
        SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
               full_date, CAST(day(full_date) AS INTEGER) AS day,
               CAST(week(full_date) AS INTEGER) AS iso_week,
               CAST(month(full_date) AS INTEGER) AS month, CAST(quarter(full_date) AS INTEGER) AS quarter,
               CAST(year(full_date) AS INTEGER) AS year,
               CAST(isodow(full_date) AS INTEGER) AS iso_weekday, isodow(full_date) >= 6 AS is_weekend,
               CAST(year(full_date) + CASE WHEN month(full_date) >= 7 THEN 1 ELSE 0 END AS INTEGER)
                   AS fiscal_year,
               CAST(coalesce(n, 0) AS BIGINT) AS orders
        FROM days LEFT JOIN per_day ON full_date = d""",
    "dim_surrogate_keys": """
        SELECT p_partkey, 1000 + row_number() OVER (ORDER BY p_name, p_partkey) AS part_key FROM part""",
    "dim_unknown_member": """
        SELECT s_suppkey + 1 AS salesperson_key, s_suppkey AS salesperson_id_source,
               concat(split_part(s_name, '#', 1), ' ', split_part(s_name, '#', 2)) AS full_name,
               'REP' AS job_title
        FROM supplier
        UNION ALL SELECT -1, -1, 'VENTA POR INTERNET / SIN VENDEDOR', 'N/A'""",
    "scd1_merge_customer": _MERGED_CUSTOMERS + """
        SELECT customer_id, segment, priority,
               CASE WHEN action = 'keep' THEN TIMESTAMP '1996-06-30' ELSE TIMESTAMP '2024-02-01' END
                   AS loaded_at,
               CASE WHEN action = 'keep' THEN 'first' ELSE 'loader' END AS load_user, action
        FROM merged""",
    "scd1_merge_counts": _MERGED_CUSTOMERS + """
        SELECT action, count(*) AS rows FROM merged GROUP BY action""",
    "scd1_change_detection": _CUSTOMERS + """
        SELECT k.o_custkey AS customer_id, k.priority IS DISTINCT FROM l.priority AS changed,
               coalesce(k.priority <> l.priority, false) AS changed_plain
        FROM known k JOIN later l ON k.o_custkey = l.o_custkey""",
    "scd1_source_distinct": """
        SELECT DISTINCT c_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey""",
    "scd1_dim_territory": _dimension_sql(
        "dim_territory",
        _TERRITORIES.format(
            group="CASE r_name WHEN 'ASIA' THEN 'APAC' WHEN 'EUROPE' THEN 'Sin Grupo' ELSE r_name END",
            condition="n_nationkey IN (SELECT c_nationkey FROM orders JOIN customer"
                      " ON o_custkey = c_custkey WHERE o_orderdate <= '1995-01-02')"),
        _TERRITORIES.format(group="r_name", condition="true")),
    "scd1_dim_salesperson": _dimension_sql(
        "dim_salesperson", _SELLERS.format(condition="l_shipdate <= '1995-01-05'"),
        _SELLERS.format(condition="year(l_shipdate) = (SELECT year(max(l_shipdate)) FROM lineitem)")),
    "scd1_dim_product": _dimension_sql(
        "dim_product", _PRODUCTS.format(condition="l_shipdate <= '1995-03-01'"),
        _PRODUCTS.format(condition="l_shipdate > '1995-03-01'")),
    "scd1_dim_promotion": _dimension_sql(
        "dim_promotion", _PROMOTIONS.format(condition="l_shipdate <= '1995-01-03'"),
        _PROMOTIONS.format(condition="true")),
}
