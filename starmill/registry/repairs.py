"""Queries on what loads meet in practice: missed merges, NULLs, late and tied rows, a second stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.operators.history import scd2_history, scd2_incremental
from starmill.operators.keys import rank_all
from starmill.plans.loads import Warehouse
from starmill.registry.context import LOAD_USER, LOADED_AT, roles, table
from starmill.sources.shared import Scratch, fresh_dir
from starmill.sources.store import Store
from starmill.streaming.merge_stream import start_merge_stream

FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 1, 2)


def missed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of territories are staged before one merge; the second renames some of the first."""
    src = dict(roles(spark, sf_dir))
    territories = src["sales_territory"]
    even = territories.where("territory_id % 2 = 0").withColumns(
        {"name": F.concat(F.lit("old "), "name"), "modified_date": F.lit(FIRST).cast("timestamp_ntz")})
    rest = territories.where("territory_id % 3 = 0 OR territory_id % 2 = 1").withColumn(
        "modified_date", F.lit(SECOND).cast("timestamp_ntz"))
    warehouse = Warehouse(spark, fresh_dir(spark, "missed"), user=LOAD_USER, clock=lambda: LOADED_AT)
    for batch in (even, rest):
        warehouse.stage("territory", {**src, "sales_territory": batch})
    warehouse.load_dimension("dim_territory")
    return warehouse.dimension("dim_territory").select(
        "territory_key", "territory_id_source", "territory_name")


def rank_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by balance; a balance below zero counts as unknown."""
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", balance.alias("balance"))
    return rank_all(customers, "balance", "place", ["c_custkey"]).select(
        "c_custkey", "balance", F.col("place").cast("long").alias("place"))


def late_and_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event arrives late; times are cut to hours, so many tie; some users are unknown."""
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 97 != 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("ts"),
        "event_type", "event_id")
    # Of events at one time the later batch has all or none, so that its rows decide.
    late = F.coalesce(F.hour("ts") % 3 == 0, F.lit(True))
    options = dict(keys=["user_id"], ts="ts", attributes=["event_type"], tie=["event_id"])
    scratch = Scratch(spark, "late")
    base = scratch.table(scd2_history(events.where(~late), hot_rows=None, scratch=scratch, **options))
    plain = scd2_incremental(base, events.where(late), hot_rows=None, scratch=scratch, **options)
    sliced = scd2_incremental(base, events.where(late), hot_rows=1, scratch=scratch, **options)
    return plain.withColumn("way", F.lit("plain")).unionByName(sliced.withColumn("way", F.lit("sliced")))


def second_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders streamed into one table under checkpoints of their own."""
    area = fresh_dir(spark, "streams")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    store = Store(spark, f"{area}/store")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.parquet(f"{area}/in{half}")
        start_merge_stream(spark, f"{area}/in{half}", events.schema, store, "last_seen", keys=["user_id"],
                           attributes=["event_type"], newest_by=["ts", "event_id"],
                           checkpoint=f"{area}/checkpoint{half}").awaitTermination()
    return store.read("last_seen").select("user_id", "event_type", "ts")


QUERIES = {
    "scd1_missed_batch": missed_batch,
    "kpi_rank_with_nulls": rank_with_nulls,
    "scd2_incremental_late": late_and_tied,
    "stream_second_checkpoint": second_stream,
}

ORACLE = {
    "scd1_missed_batch": """
        SELECT row_number() OVER (ORDER BY n_nationkey) AS territory_key,
               CAST(n_nationkey AS BIGINT) AS territory_id_source,
               CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 3 <> 0 THEN 'old ' || n_name ELSE n_name END
                   AS territory_name
        FROM nation""",
    "kpi_rank_with_nulls": """
        SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
               rank() OVER (ORDER BY CASE WHEN c_acctbal >= 0 THEN c_acctbal END DESC NULLS LAST) AS place
        FROM customer""",
    "scd2_incremental_late": """
        WITH seen AS (
            SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id,
                   CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_type, event_id
            FROM events WHERE event_id % 97 <> 0),
        last_of AS (
            SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
        -- The earlier batch keeps its changes only; a late change holds until the next of them.
        base AS (
            SELECT * FROM last_of WHERE hour(ts) % 3 <> 0
            QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts)),
        changed AS (
            SELECT * FROM (SELECT * FROM base UNION ALL SELECT * FROM last_of WHERE hour(ts) % 3 = 0)
            QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts)),
        versions AS (
            SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to,
                   lead(ts) OVER w IS NULL AS is_current, row_number() OVER w AS version
            FROM changed WINDOW w AS (PARTITION BY user_id ORDER BY ts))
        SELECT versions.*, way FROM versions, (VALUES ('plain'), ('sliced')) AS ways(way)""",
    "stream_second_checkpoint": """
        SELECT user_id, event_type, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
}
