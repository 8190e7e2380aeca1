"""Schemas of the staging tables, the star and the run log."""

from pyspark.sql.types import (
    DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType)

_LONG, _INT, _TEXT, _DAY, _TIME = (
    LongType(), IntegerType(), StringType(), DateType(), TimestampNTZType())
_MONEY = DecimalType(19, 4)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_BATCH = {"modified_date": _TIME, "loaded_at": _TIME, "batch_id": _TEXT}
_LOAD = {"loaded_at": _TIME, "load_user": _TEXT}

STAGING = {
    "customer": _schema(
        customer_id=_LONG, person_id=_LONG, customer_type=_TEXT, full_name=_TEXT, email=_TEXT,
        phone=_TEXT, city=_TEXT, state_province=_TEXT, country=_TEXT, territory_id=_LONG, **_BATCH),
    "product": _schema(
        product_id=_LONG, product_name=_TEXT, product_number=_TEXT, color=_TEXT, size=_TEXT,
        weight=DecimalType(8, 2), subcategory=_TEXT, category=_TEXT,
        standard_cost=DecimalType(10, 2), list_price=DecimalType(10, 2),
        sell_start_date=_DAY, sell_end_date=_DAY, **_BATCH),
    "salesperson": _schema(
        salesperson_id=_LONG, full_name=_TEXT, job_title=_TEXT, hire_date=_DAY, territory_id=_LONG,
        territory_name=_TEXT, sales_quota=_MONEY, bonus=_MONEY,
        commission_pct=DecimalType(5, 2), **_BATCH),
    "promotion": _schema(
        promotion_id=_LONG, promotion_name=_TEXT, discount_pct=DecimalType(5, 4),
        promotion_type=_TEXT, category=_TEXT, start_date=_DAY, end_date=_DAY, min_qty=_INT,
        max_qty=_INT, **_BATCH),
    "territory": _schema(
        territory_id=_LONG, territory_name=_TEXT, country_name=_TEXT, group_name=_TEXT, **_BATCH),
}

WAREHOUSE = {
    "dim_customer": _schema(
        customer_key=_LONG, customer_id_source=_LONG, full_name=_TEXT, email=_TEXT,
        customer_type=_TEXT, territory_id_source=_LONG, **_LOAD),
    "dim_product": _schema(
        product_key=_LONG, product_id_source=_LONG, product_name=_TEXT, color=_TEXT,
        subcategory=_TEXT, category=_TEXT, **_LOAD),
    "dim_promotion": _schema(
        promotion_key=_LONG, promotion_id_source=_LONG, promotion_name=_TEXT, promotion_type=_TEXT,
        discount_pct=DecimalType(5, 4), start_date=_DAY, end_date=_DAY, **_LOAD),
    "dim_territory": _schema(
        territory_key=_LONG, territory_id_source=_LONG, territory_name=_TEXT, country=_TEXT,
        group_name=_TEXT, **_LOAD),
    "dim_salesperson": _schema(
        salesperson_key=_LONG, salesperson_id_source=_LONG, full_name=_TEXT, job_title=_TEXT,
        territory_id_source=_LONG, **_LOAD),
    # order_year is derived from date_key and is the partition column on disk.
    "fact_sales": _schema(
        date_key=_INT, product_key=_LONG, customer_key=_LONG, salesperson_key=_LONG,
        territory_key=_LONG, promotion_key=_LONG, sales_order_id=_LONG, order_qty=_INT,
        unit_price=DecimalType(10, 2), unit_price_discount=DecimalType(5, 2),
        line_total=DecimalType(12, 2), order_year=_INT),
}

# The stored fact also holds the product's id in the source, which tells lines of an order apart even
# where no product is known by it.
STORED_FACT = StructType([*WAREHOUSE["fact_sales"].fields, StructField("product_id_source", _LONG)])

# Up to when each source table was followed; orders with lines that found no place yet.
SOURCE_MARKS = _schema(source=_TEXT, watermark=_TIME)
WAITING_ORDERS = _schema(sales_order_id=_LONG)

# Results of the checks of one part of the stored fact.
ORPHANS = _schema(dimension=_TEXT, rows=_LONG)
DUPLICATES = _schema(sales_order_id=_LONG, product_key=_LONG, rows=_LONG)

# The staging version that a table has taken in last.
MERGED = _schema(version=_LONG)

RUN_LOG = _schema(
    process=_TEXT, batch_id=_TEXT, state=_TEXT, started_at=_TIME, ended_at=_TIME,
    watermark=_TIME, rows_affected=_LONG, message=_TEXT)
