"""Every registered query against its SQL on the smallest tables, and the shape of some plans."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from starmill.registry import ORACLE, QUERIES
from conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def table_of(arrow):
    names = sorted(arrow.column_names)
    types = {n: re.sub("large_|_view", "", str(arrow.schema.field(n).type)) for n in names}
    rows = zip(*[arrow.column(n).to_pylist() for n in names])
    return types, sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    found = table_of(QUERIES[name](spark, FOLDER).toArrow())
    expected = table_of(duck.sql(ORACLE[name]).to_arrow_table())
    assert found == expected


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["group_name", "category", "sales", "orders"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_predicate_reaches_the_scan(spark):
    text = plan(QUERIES["stg_incremental_filter"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_year_slice_prunes_fact_partitions(spark):
    text = plan(QUERIES["kpi_sliced"](spark, FOLDER))
    assert "order_year" in re.search(r"PartitionFilters: \[([^\]]*)\]", text[text.index("date_key"):]).group(1)


def test_totals_read_two_columns(spark):
    text = plan(QUERIES["kpi_totals"](spark, FOLDER))
    assert "ReadSchema: struct<order_qty:int,line_total:decimal(12,2)>" in text


def test_no_query_pairs_rows_without_a_key(spark):
    for name in ("fact_load", "fact_idempotent_load", "scd2_point_in_time_join", "stg_extract_customer",
                 "audit_watermark_drift", "mart_territory_category", "dq_fact_reconciliation"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_known_lines_are_discarded_before_the_header_join(spark):
    text = plan(QUERIES["fact_idempotent_load"](spark, FOLDER))
    assert text.count("WindowGroupLimit") >= 2  # duplicates are cut before the shuffle
    assert "LeftAnti" in text


FACT_QUERIES = ["fact_load", "fact_idempotent_load", "oltp_territory_category"]


@pytest.mark.parametrize("name", FACT_QUERIES)
def test_products_and_customers_are_not_sent_to_the_driver(spark, name):
    """Tables that grow with the sales are shuffled, however small they are here."""
    text = plan(QUERIES[name](spark, FOLDER))
    assert "ShuffledHashJoin" in text
    joins = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
    assert not [j for j in joins if re.search(r"customer_id|o_custkey|product_id#|product_key", j)]


def test_sums_per_order_use_the_layout_of_the_header_join(spark):
    text = plan(QUERIES["oltp_territory_category"](spark, FOLDER))
    assert not re.search(r"hashpartitioning\(group_name#\d+, category#\d+, sales_order_id", text)
