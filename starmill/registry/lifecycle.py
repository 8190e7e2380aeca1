"""Queries on warehouses over several loads: later batches, late rows, unknown members, crashes, checks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.functions import labels
from starmill.operators.figures import Figures
from starmill.operators.history import point_in_time, scd2_history, scd2_incremental, scd2_keyed
from starmill.plans import marts
from starmill.plans.audit import RunLog, current_state, monitor
from starmill.plans.extracts import extract_customer
from starmill.plans.facts import FACT_COLUMNS, VERSION_KEY, load_fact
from starmill.plans.loads import Warehouse
from starmill.registry import audit as audit_queries, dimensions as dimension_queries
from starmill.registry.context import LOAD_USER, LOADED_AT, loaded_warehouse, roles, table
from starmill.registry.dimensions import merge_customer
from starmill.registry.history import seller_states
from starmill.registry.quality import incomplete_dimensions
from starmill.registry.runs import run_log
from starmill.registry.sql import CUSTOMER, LINES, PRODUCT, PROMOTION, SALESPERSON, STAR, TERRITORY
from starmill.sources.roles import LINE_ORDER, sales_person
from starmill.sources.shared import Scratch, fresh_dir
from starmill.sources.store import Store
from starmill.streaming.merge_stream import start_merge_stream

FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 1, 2)
# Orders before this day are in the first fact load.
CUT = datetime(1999, 1, 1)
CONTACTS_SINCE = datetime(2024, 1, 25)
EVER = timedelta(days=20_000)


def _at(value: datetime):
    return F.lit(value).cast("timestamp_ntz")


def new_warehouse(spark: SparkSession, label: str, **options) -> Warehouse:
    return Warehouse(spark, fresh_dir(spark, label), user=LOAD_USER, clock=lambda: LOADED_AT, **options)


def warehouse_beside(spark: SparkSession, sf_dir: str, label: str, **options) -> Warehouse:
    """A warehouse of its own with the dimensions of the loaded star and no sales yet."""
    warehouse = new_warehouse(spark, label, **options)
    for name, dimension in loaded_warehouse(spark, sf_dir).dimensions().items():
        warehouse.store.write(f"dw/{name}", dimension)
    return warehouse


def two_loads(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """Sales loaded up to the cut, then by a later load that meets all orders."""
    src, warehouse = dict(roles(spark, sf_dir)), warehouse_beside(spark, sf_dir, label)
    before = src["sales_order_header"].where(F.col("order_date") < _at(CUT))
    for header in (before, src["sales_order_header"]):
        warehouse.load_sales({**src, "sales_order_header": header}, duplicates="keep", sales_person=sales_person())
    return warehouse


def second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_loads(spark, sf_dir, "second-load").sales().select(*FACT_COLUMNS)


def unknown_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth product is in no dimension when its sales arrive, which are loaded twice.

    Once such sales get a placeholder member, which a late load of the products fills in, and once the
    unknown member.
    """
    src, found = dict(roles(spark, sf_dir)), []
    some = src["product"].where("product_id % 5 <> 0")
    for way in ("infer", "unknown"):
        warehouse = warehouse_beside(spark, sf_dir, f"products-{way}")
        warehouse.store.write("dw/dim_product", warehouse.dimension("dim_product").limit(0))
        warehouse.stage("product", {**src, "product": some})
        warehouse.load_dimension("dim_product")
        for _ in range(2):
            warehouse.load_sales(src, full=True, duplicates="first", line_order=LINE_ORDER, sales_person=sales_person(),
                                 on_missing={"dim_product": way})
        warehouse.stage("product", src, lookback=EVER)
        warehouse.load_dimension("dim_product")
        products = warehouse.dimension("dim_product").select("product_key", "product_id_source", "product_name")
        found.append(warehouse.sales().groupBy("product_key")
                     .agg(F.count("*").alias("lines"), marts.total("line_total").alias("sales"))
                     .join(products, "product_key", "left").withColumn("way", F.lit(way)))
    return found[0].unionByName(found[1]).select("way", "product_key", "product_id_source", "product_name", "lines", "sales")


def load_with_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by the version of their salesperson; a quarter's states arrive between two fact loads."""
    scratch = Scratch(spark, "versions")
    seen = scratch.table(seller_states(spark, sf_dir).withColumnRenamed("salesperson_id", "salesperson_id_source"))
    late = F.month("seen_at") % 3 == 0
    options = dict(keys=["salesperson_id_source"], ts="seen_at", attributes=["territory_id"], key=VERSION_KEY, scratch=scratch)
    first = scratch.table(scd2_keyed(None, seen.where(~late), **options))
    second = scratch.table(scd2_keyed(first, seen.where(late), **options))
    src, dims = roles(spark, sf_dir), loaded_warehouse(spark, sf_dir).dimensions()
    header, parts = src["sales_order_header"], []
    for orders, versions in ((header.where(F.col("order_date") < _at(CUT)), first), (header, second)):
        parts.append(scratch.table(load_fact(
            src["sales_order_detail"], orders, dims, existing=parts[0] if parts else None, sales_person=sales_person(),
            versions={"dim_salesperson": versions})))
    return parts[0].unionByName(parts[1])


def hot_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event counts as a sale of one user on one day; all of the user's versions are older or newer."""
    events = table(spark, sf_dir, "events")
    states = Scratch(spark, "states").table(scd2_history(
        events.where("event_id % 3 <> 0"), ["user_id"], "ts", ["event_type"], tie=["event_id"]))
    someone = events.agg(F.min("user_id")).scalar()
    day = events.agg(F.date_trunc("day", F.max("ts")).cast("timestamp_ntz")).scalar()
    sales = events.where("event_id % 3 = 0").select(someone.alias("user_id"), day.alias("ts"), "event_id").unionByName(
        events.where("event_id % 3 = 1").select("user_id", "ts", "event_id"))
    placed = point_in_time(sales, states, ["user_id"], "ts", ["event_type", "version"], hot_rows=20)
    return placed.groupBy("user_id", "event_type", "version").agg(
        F.count("*").alias("sales"), F.sum("event_id").alias("events"))


def incremental_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times are cut to hours, so many tie; rows of one time fall into both batches, in either order."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_type", "event_id")
    options, found = dict(keys=["user_id"], ts="ts", attributes=["event_type"], tie=["event_id"]), []
    for way, late in (("even late", 0), ("odd late", 1)):
        scratch = Scratch(spark, "tied")
        is_late = F.col("event_id") % 2 == late
        base = scratch.table(scd2_history(events.where(~is_late), scratch=scratch, keep=["event_id"], **options))
        found.append(scd2_incremental(base, events.where(is_late), scratch=scratch, **options).withColumn("way", F.lit(way)))
    return found[0].unionByName(found[1])


def _territory_batches(spark: SparkSession, sf_dir: str, warehouse: Warehouse) -> None:
    """Two batches of territories, staged and merged one after the other."""
    src = dict(roles(spark, sf_dir))
    territories = src["sales_territory"]
    even = territories.where("territory_id % 2 = 0").withColumns(
        {"name": F.concat(F.lit("old "), "name"), "modified_date": _at(FIRST)})
    rest = territories.where("territory_id % 3 = 0 OR territory_id % 2 = 1").withColumn("modified_date", _at(SECOND))
    for batch in (even, rest):
        warehouse.stage("territory", {**src, "sales_territory": batch})
        warehouse.load_dimension("dim_territory")


def first_history_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension has taken in both batches before its history is loaded for the first time."""
    warehouse = new_warehouse(spark, "late-history", histories=["dim_territory"])
    _territory_batches(spark, sf_dir, warehouse)
    warehouse.load_history("dim_territory")
    return warehouse.history("dim_territory").select(
        VERSION_KEY, "territory_id_source", "territory_name", "valid_from", "valid_to", "is_current", "version")


def bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in sixteen buckets; the second batch touches some of them."""
    src, warehouse = dict(roles(spark, sf_dir)), new_warehouse(spark, "buckets", buckets={"dim_customer": 16})
    customers = src["customer"]
    older = customers.where("customer_id % 3 = 0").withColumns(
        {"territory_id": F.col("territory_id") + 100, "modified_date": _at(FIRST)})
    newer = customers.where("customer_id % 30 = 0 OR customer_id % 3 = 1").withColumn("modified_date", _at(SECOND))
    for batch in (older, newer):
        warehouse.stage("customer", {**src, "customer": batch})
        warehouse.load_dimension("dim_customer")
    return warehouse.dimension("dim_customer").select(
        "customer_key", "customer_id_source", "customer_type", "territory_id_source")


def changed_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers none of whom is newer than the watermark, but some of whom have a newer contact row."""
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).first()[0]
    contacts = ("email_address", "person_phone", "business_entity_address")
    return extract_customer(roles(spark, sf_dir), last, changed=dict.fromkeys(contacts, CONTACTS_SINCE))


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge did, counted by the write of its result."""
    actions = ("insert", "update", "keep")
    written = Figures(merge_customer(spark, sf_dir), **{a: F.count_if(F.col("action") == a) for a in actions})
    Scratch(spark, "observed").table(written.rows)
    counts = [(a, written[a]) for a in actions if written[a]]
    return spark.createDataFrame(counts, "action string, rows long")


class _DiesBeforeItsClaim(Store):
    """A store whose writer is gone when its data is written and its version not claimed yet."""

    def _commit(self, *version) -> bool:
        raise InterruptedError("killed between write and claim")


def crash_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two streams into one table the first dies in its first batch; it goes on when the second is through."""
    area = fresh_dir(spark, "crash")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.parquet(f"{area}/in{half}")
    store = Store(spark, f"{area}/store")

    def run(half: int, store: Store) -> None:
        start_merge_stream(spark, f"{area}/in{half}", events.schema, store, "last_seen", keys=["user_id"],
                           attributes=["event_type"], newest_by=["ts", "event_id"],
                           checkpoint=f"{area}/checkpoint{half}").awaitTermination()

    try:
        run(0, _DiesBeforeItsClaim(spark, f"{area}/store"))
    except StreamingQueryException:
        pass
    else:
        raise AssertionError("the first stream was meant to die")
    run(1, store)
    run(0, store)
    return store.read("last_seen").select("user_id", "event_type", "ts")


def log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of all processes from a log that was folded twice and goes on."""
    store = Store(spark, fresh_dir(spark, "log"))
    log, rows = RunLog(store), run_log(table(spark, sf_dir, "events"))
    ended = F.col("ended_at").isNotNull()
    for days in ("01 AND 10", "11 AND 20", "21 AND 31"):
        store.append(RunLog.TABLE, rows.where(ended).where(f"day(started_at) BETWEEN {days}"),
                     f"runs-{days[:2]}-end")
        if not days.startswith("2"):
            log.compact()
    store.append(RunLog.TABLE, rows.where(~ended), "open-start")
    return current_state(log.read())


def written_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of loads that ran, of one that failed and of one that has not ended, newest first."""
    src = dict(roles(spark, sf_dir))
    now = iter(range(10_000))
    warehouse = Warehouse(spark, fresh_dir(spark, "written-log"), user=LOAD_USER,
                          clock=lambda: LOADED_AT + timedelta(seconds=next(now)))
    warehouse.stage("territory", src)
    warehouse.stage("promotion", src)
    warehouse.load_dimension("dim_territory")
    warehouse.stage("territory", src)  # nothing new
    broken = {**src, "product_category": src["product_category"].withColumn("name", F.raise_error(F.lit("source lost")))}
    try:
        warehouse.stage("product", broken)
    except Exception as error:
        if "source lost" not in str(error):
            raise
    warehouse.log.start(labels.STG_CUSTOMER, "open", warehouse.clock())
    warehouse.log.compact()
    shown = monitor(warehouse.log.read())
    return shown.select("process", "state", "rows_affected", "watermark",
                        F.col("message").contains("source lost").alias("lost"), (F.col("seconds") > 0).alias("took_time"))


def checked_sales(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """Two loads and a part that holds some of their lines again; every part is checked as it arrives."""
    warehouse = two_loads(spark, sf_dir, label)
    dims = incomplete_dimensions(spark, sf_dir)
    warehouse.check_sales(dims)
    again = warehouse._stored_sales().where("sales_order_id % 100 = 0")
    warehouse.store.append("dw/fact_sales", Scratch(spark, label).table(again), "again", partition_by=["order_year"])
    warehouse.check_sales(dims)
    return warehouse


def stored_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_sales(spark, sf_dir, "orphans").orphans()


def stored_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_sales(spark, sf_dir, "duplicates").duplicates()


QUERIES = {
    "fact_load_scd2": load_with_versions,
    "fact_second_load": second_load,
    "fact_unknown_product": unknown_products,
    "scd1_bucketed_merge": bucketed_merge,
    "scd1_observed_counts": observed_counts,
    "scd2_hot_instant": hot_instant,
    "scd2_incremental_tied": incremental_tied,
    "scd2_first_history_late": first_history_late,
    "stg_extract_customer_changed_contact": changed_contacts,
    "stream_crash_between": crash_between,
    "audit_log_compacted": log_compacted,
    "audit_written_log": written_log,
    "dq_stored_fact_orphans": stored_orphans,
    "dq_stored_fact_duplicates": stored_duplicates,
}

_SEEN = """
    SELECT l_suppkey, l_shipdate,
           CASE WHEN l_linestatus = 'O' THEN CAST(s_nationkey AS BIGINT) END AS territory_id
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    QUALIFY row_number() OVER (
        PARTITION BY l_suppkey, strftime(l_shipdate, '%Y-%m') ORDER BY l_shipdate DESC,
        l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_returnflag DESC, l_linestatus DESC) = 1"""


def _tied(way: str, late: int) -> str:
    return f"""
        SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to,
               lead(ts) OVER w IS NULL AS is_current, row_number() OVER w AS version, event_id, '{way}' AS way
        FROM (
            SELECT * FROM (
                SELECT * FROM (
                    SELECT * FROM (
                        SELECT * FROM (
                            SELECT * FROM hours WHERE event_id % 2 <> {late}
                            QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
                        QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts))
                    UNION ALL SELECT * FROM hours WHERE event_id % 2 = {late})
                QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
            QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts))
        WINDOW w AS (PARTITION BY user_id ORDER BY ts)"""


_STORED = f"""
    {STAR},
    stored AS (
        SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE sales_order_id % 100 = 0)"""

ORACLE = {
    "scd1_observed_counts": dimension_queries.ORACLE["scd1_merge_counts"],
    "fact_load_scd2": f"""
        WITH dim_product AS ({PRODUCT}), dim_salesperson AS ({SALESPERSON}), dim_territory AS ({TERRITORY}),
        dim_customer AS ({CUSTOMER}), dim_promotion AS ({PROMOTION}), lines AS ({LINES}), seen AS ({_SEEN}),
        on_time AS (
            SELECT * FROM seen WHERE month(l_shipdate) % 3 <> 0
            WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate)
            QUALIFY row_number() OVER w = 1 OR territory_id IS DISTINCT FROM lag(territory_id) OVER w),
        keyed AS (SELECT *, row_number() OVER (ORDER BY l_suppkey, l_shipdate) AS version_key FROM on_time),
        early AS (SELECT *, lead(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS until FROM keyed),
        starts AS (
            SELECT * FROM (
                SELECT l_suppkey, l_shipdate, territory_id, version_key FROM keyed
                UNION ALL SELECT *, NULL FROM seen WHERE month(l_shipdate) % 3 = 0)
            WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate)
            QUALIFY version_key IS NOT NULL OR row_number() OVER w = 1
                    OR territory_id IS DISTINCT FROM lag(territory_id) OVER w),
        numbered AS (
            SELECT l_suppkey, l_shipdate, territory_id, coalesce(version_key,
                   (SELECT max(version_key) FROM keyed)
                   + row_number() OVER (PARTITION BY version_key IS NULL ORDER BY l_suppkey, l_shipdate)) AS version_key
            FROM starts),
        late AS (SELECT *, lead(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS until FROM numbered)
        SELECT date_key, product_key, customer_key,
               CAST(coalesce(e.version_key, n.version_key, -1) AS BIGINT) AS salesperson_key, territory_key, promotion_key,
               l_orderkey AS sales_order_id, order_qty, unit_price, unit_price_discount, line_total
        FROM lines
        JOIN dim_product p ON l_partkey = p.product_id
        JOIN dim_customer c ON o_custkey = c.customer_id
        JOIN dim_territory t ON c_nationkey = t.territory_id
        JOIN dim_promotion d ON lines.promotion_id = d.promotion_id
        LEFT JOIN early e ON o_orderdate < '{CUT}' AND seller = e.l_suppkey AND o_orderdate >= e.l_shipdate
             AND (e.until IS NULL OR o_orderdate < e.until)
        LEFT JOIN late n ON o_orderdate >= '{CUT}' AND seller = n.l_suppkey AND o_orderdate >= n.l_shipdate
             AND (n.until IS NULL OR o_orderdate < n.until)""",
    "fact_second_load": f"WITH {STAR} SELECT * FROM fact",
    "fact_unknown_product": f"""
        WITH {STAR},
        single AS (
            SELECT l_partkey, line_total FROM lines JOIN dim_promotion d ON lines.promotion_id = d.promotion_id
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber,
                l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) = 1),
        keyed AS (
            SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey % 5 = 0, p_partkey) AS product_key
            FROM part WHERE p_partkey % 5 <> 0 OR p_partkey IN (SELECT l_partkey FROM single))
        SELECT 'infer' AS way, product_key, p_partkey AS product_id_source, p_name AS product_name, count(*) AS lines,
               CAST(sum(line_total) AS DECIMAL(22,2)) AS sales
        FROM single JOIN keyed ON l_partkey = p_partkey GROUP BY ALL
        UNION ALL
        SELECT 'unknown', CASE WHEN l_partkey % 5 = 0 THEN -1 ELSE product_key END,
               CASE WHEN l_partkey % 5 <> 0 THEN p_partkey END, CASE WHEN l_partkey % 5 <> 0 THEN p_name END, count(*),
               CAST(sum(line_total) AS DECIMAL(22,2))
        FROM single JOIN keyed ON l_partkey = p_partkey GROUP BY ALL""",
    "scd1_bucketed_merge": """
        SELECT row_number() OVER (ORDER BY c_custkey % 3 <> 0, c_custkey) AS customer_key, c_custkey AS customer_id_source,
               CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 'PERSONA' ELSE 'EMPRESA' END AS customer_type,
               CAST(CASE WHEN c_custkey % 3 = 0 AND c_custkey % 30 <> 0 THEN c_nationkey + 100 ELSE c_nationkey END AS BIGINT)
                   AS territory_id_source
        FROM customer WHERE c_custkey % 3 <> 2""",
    "scd2_hot_instant": """
        WITH changed AS (
            SELECT * FROM events WHERE event_id % 3 <> 0
            QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)),
        states AS (
            SELECT user_id, event_type, ts, lead(ts) OVER w AS until, row_number() OVER w AS version
            FROM changed WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        sales AS (
            SELECT (SELECT min(user_id) FROM events) AS user_id,
                   (SELECT CAST(date_trunc('day', max(ts)) AS TIMESTAMP) FROM events) AS ts, event_id
            FROM events WHERE event_id % 3 = 0
            UNION ALL SELECT user_id, ts, event_id FROM events WHERE event_id % 3 = 1)
        SELECT s.user_id, v.event_type, v.version, count(*) AS sales, CAST(sum(event_id) AS BIGINT) AS events
        FROM sales s LEFT JOIN states v ON s.user_id = v.user_id AND s.ts >= v.ts AND (v.until IS NULL OR s.ts < v.until)
        GROUP BY ALL""",
    "scd2_incremental_tied": f"""
        WITH hours AS (SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_type, event_id FROM events)
        {_tied("even late", 0)} UNION ALL {_tied("odd late", 1)}""",
    "scd2_first_history_late": """
        WITH versions AS (
            SELECT n_nationkey, 'old ' || n_name AS territory_name, TIMESTAMP '2024-01-01' AS valid_from
            FROM nation WHERE n_nationkey % 2 = 0
            UNION ALL SELECT n_nationkey, n_name, TIMESTAMP '2024-01-02' FROM nation
            WHERE n_nationkey % 3 = 0 OR n_nationkey % 2 = 1)
        SELECT row_number() OVER (ORDER BY n_nationkey, valid_from) AS version_key,
               CAST(n_nationkey AS BIGINT) AS territory_id_source, territory_name, valid_from,
               lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current,
               row_number() OVER w AS version
        FROM versions WINDOW w AS (PARTITION BY n_nationkey ORDER BY valid_from)""",
    "stg_extract_customer_changed_contact": f"""
        WITH latest AS (
            SELECT user_id, event_type, event_id, ts FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
        ordered AS (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1)
        SELECT c_custkey AS customer_id, c_custkey AS person_id, 'PERSONA' AS customer_type,
               concat(CASE WHEN c_acctbal >= 0 THEN split_part(c_name, '#', 1) END, ' ', split_part(c_name, '#', 2))
                   AS full_name,
               'user' || e.event_id || '@example.com' AS email, '555-' || p.event_id AS phone,
               CASE WHEN l.event_id IS NOT NULL THEN 'City ' || c_custkey END AS city,
               CASE WHEN l.event_id IS NOT NULL THEN n_name END AS state_province,
               CASE WHEN l.event_id IS NOT NULL THEN r_name END AS country,
               CAST(c_nationkey AS BIGINT) AS territory_id,
               greatest(coalesce(last, TIMESTAMP '1995-01-01'), e.ts, p.ts, l.ts) AS modified_date
        FROM customer
        LEFT JOIN ordered ON c_custkey = o_custkey
        LEFT JOIN latest e ON e.user_id = c_custkey AND e.event_type = 'signup'
        LEFT JOIN latest p ON p.user_id = c_custkey AND p.event_type = 'click'
        LEFT JOIN latest l ON l.user_id = c_custkey AND l.event_type = 'purchase'
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type IN ('signup', 'click', 'purchase')
                            AND ts > '{CONTACTS_SINCE}')""",
    "stream_crash_between": """
        SELECT user_id, event_type, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "audit_log_compacted": audit_queries.ORACLE["audit_current_state"],
    "audit_written_log": """
        SELECT 'STG_TERRITORIO' AS process, 'OK' AS state, CAST(0 AS BIGINT) AS rows_affected,
               TIMESTAMP '1995-01-01' AS watermark, CAST(NULL AS BOOLEAN) AS lost, true AS took_time
        UNION ALL SELECT 'STG_PROMOCION', 'OK', count(DISTINCT CAST(round(l_discount * 100) AS BIGINT)), max(l_shipdate),
               NULL, true FROM lineitem
        UNION ALL SELECT 'DW_DIM_TERRITORIO', 'OK', count(*), NULL, NULL, true FROM nation
        UNION ALL SELECT 'STG_PRODUCTO', 'ERROR', NULL, NULL, true, true
        UNION ALL SELECT 'STG_CLIENTE', 'EN PROCESO', NULL, NULL, NULL, NULL""",
    "dq_stored_fact_orphans": f"""
        WITH {_STORED}
        SELECT 'dim_date' AS dimension, count(*) AS rows FROM stored WHERE date_key < 20000101
        UNION ALL SELECT 'dim_product', count(*) FROM stored JOIN dim_product USING (product_key) WHERE category = 'PROMO'
        UNION ALL SELECT 'dim_customer', count(*) FROM stored JOIN dim_customer USING (customer_key)
        WHERE customer_id NOT IN (SELECT user_id FROM events)
        UNION ALL SELECT unnest(['dim_salesperson', 'dim_territory', 'dim_promotion']), 0""",
    "dq_stored_fact_duplicates": f"""
        WITH {_STORED}
        SELECT sales_order_id, product_key, count(*) AS rows FROM stored GROUP BY ALL HAVING count(*) > 1""",
}
