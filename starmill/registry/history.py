"""Type 2 history of the event type a user was last seen with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.operators.history import point_in_time, scd2_history, scd2_incremental
from starmill.plans import marts
from starmill.plans.facts import order_lines
from starmill.registry.context import roles, table, tables
from starmill.registry.dimensions import sellers_at
from starmill.registry.sql import LINES
from starmill.sources.roles import sales_person
from starmill.sources.shared import Scratch

_KEYS, _STATE = ["user_id"], ["event_type"]
_HALF = "2024-01-16"


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_history(table(spark, sf_dir, "events"), _KEYS, "ts", _STATE, tie=["event_id"])


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the month as a base, the rest applied to it."""
    events, cut = table(spark, sf_dir, "events"), F.lit(_HALF).cast("timestamp_ntz")
    base = Scratch(spark, "dim").table(
        scd2_history(events.where(F.col("ts") < cut), _KEYS, "ts", _STATE, tie=["event_id"]))
    return scd2_incremental(base, events.where(F.col("ts") >= cut), _KEYS, "ts", _STATE,
                            tie=["event_id"])


def purchases_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases by the state the user was in at that moment, taken from the other events."""
    events = table(spark, sf_dir, "events")
    states = Scratch(spark, "dim").table(scd2_history(
        events.where(F.col("event_type") != "purchase"), _KEYS, "ts", _STATE, tie=["event_id"]))
    bought = events.where(F.col("event_type") == "purchase").select(
        "user_id", "ts", F.col("value").cast("decimal(12,2)").alias("value"))
    placed = point_in_time(bought, states, _KEYS, "ts", _STATE)
    return placed.groupBy("user_id", "event_type").agg(
        F.count("*").alias("purchases"), F.sum("value").cast("decimal(22,2)").alias("value"))


def seller_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Territory of each supplier as last observed in every month it shipped in."""
    t = tables(spark, sf_dir)
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    lines = t["lineitem"].withColumn("batch_id", month.cast("string"))
    return sellers_at(t, lines).select("salesperson_id", "territory_id", F.col("loaded_at").alias("seen_at"))


def sales_by_territory_then(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by the territory the salesperson had at the time of the sale, not the latest one."""
    states = Scratch(spark, "dim").table(scd2_history(
        seller_states(spark, sf_dir), ["salesperson_id"], "seen_at", ["territory_id"]))
    src = roles(spark, sf_dir)
    lines = order_lines(src["sales_order_detail"], src["sales_order_header"], sales_person())
    return marts.sales_at_time_of_sale(lines.withColumnRenamed("sales_person_id", "salesperson_id"),
                                       states, "salesperson_id", "order_date", "territory_id")


QUERIES = {
    "scd2_sales_by_territory_then": sales_by_territory_then,
    "scd2_history": history,
    "scd2_incremental": incremental,
    "scd2_point_in_time_join": purchases_by_state,
}


def _versions(condition: str) -> str:
    return f"""
        SELECT user_id, event_type, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current,
               row_number() OVER (PARTITION BY user_id ORDER BY ts) AS version
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
              FROM events WHERE {condition})
        WHERE before IS NULL OR before <> event_type"""


ORACLE = {
    "scd2_sales_by_territory_then": f"""
        WITH lines AS ({LINES}),
        seen AS (
            SELECT l_suppkey, l_shipdate,
                   CASE WHEN l_linestatus = 'O' THEN CAST(s_nationkey AS BIGINT) END AS territory_id
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
            QUALIFY row_number() OVER (
                PARTITION BY l_suppkey, strftime(l_shipdate, '%Y-%m') ORDER BY l_shipdate DESC,
                l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_returnflag DESC,
                l_linestatus DESC) = 1),
        states AS (
            SELECT *, lead(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS until
            FROM seen)
        SELECT s.territory_id, count(*) AS lines, CAST(sum(line_total) AS DECIMAL(22,2)) AS sales
        FROM lines l LEFT JOIN states s ON l.seller = s.l_suppkey AND l.o_orderdate >= s.l_shipdate
             AND (s.until IS NULL OR l.o_orderdate < s.until)
        GROUP BY s.territory_id""",
    "scd2_history": _versions("true"),
    "scd2_incremental": _versions("true"),
    "scd2_point_in_time_join": f"""
        WITH states AS ({_versions("event_type <> 'purchase'")})
        SELECT e.user_id, s.event_type, count(*) AS purchases,
               CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS value
        FROM events e LEFT JOIN states s ON e.user_id = s.user_id AND e.ts >= s.valid_from
             AND (s.valid_to IS NULL OR e.ts < s.valid_to)
        WHERE e.event_type = 'purchase' GROUP BY e.user_id, s.event_type""",
}
