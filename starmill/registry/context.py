"""Inputs shared by the registered queries: source roles and the loaded star."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from starmill.plans.loads import Warehouse
from starmill.sources.roles import TABLES, sales_person, source_roles
from starmill.sources.shared import fresh_dir
from starmill.sources.tables import read_table, read_tables

LOADED_AT = datetime(2024, 2, 1)
LOAD_USER = "loader"

# The tables hold orders from 1995 on.
CALENDAR_START, CALENDAR_END = date(1995, 1, 1), date(2030, 12, 31)

ENTITIES = ("territory", "customer", "product", "salesperson", "promotion")
DIMENSION_ORDER = ("dim_territory", "dim_customer", "dim_product", "dim_salesperson", "dim_promotion")

_loaded: dict[tuple[str, str], Warehouse] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return read_tables(spark, sf_dir, TABLES)


def roles(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return source_roles(tables(spark, sf_dir))


def build_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Run every load, dimensions before facts, into a new folder."""
    src = roles(spark, sf_dir)
    warehouse = Warehouse(spark, fresh_dir(spark, "warehouse"), user=LOAD_USER,
                          clock=lambda: LOADED_AT)
    warehouse.load_calendar(CALENDAR_START, CALENDAR_END)
    for entity in ENTITIES:
        warehouse.stage(entity, src)
    for name in DIMENSION_ORDER:
        warehouse.load_dimension(name)
    warehouse.seed_unknown_salesperson()
    # The source's lines are not unique by order and product; the star keeps them all.
    warehouse.load_sales(src, duplicates="keep", sales_person=sales_person())
    return warehouse


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star of ``sf_dir``, loaded on first use and then read like any stored star."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = build_warehouse(spark, sf_dir)
    return _loaded[key]


def star(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return loaded_warehouse(spark, sf_dir).star()
