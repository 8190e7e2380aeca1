"""A small source system with the edge rows every load has to get right."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import SparkSession

D1, D2, D3 = datetime(2014, 1, 1), datetime(2014, 6, 1), datetime(2014, 12, 31)


def money(text):
    return Decimal(text)


TABLES = {
    # 1 person, 2 company, 3 person with half a name and no contact rows
    "customer": (
        "customer_id long, person_id long, territory_id long, modified_date timestamp_ntz",
        [(1, 11, 1, D1), (2, None, 2, D1), (3, 13, 1, D2)]),
    "person": (
        "business_entity_id long, first_name string, last_name string",
        [(11, "Ana", "Ruiz"), (13, None, "X"), (21, "Luis", "Paz"), (22, "Eva", None)]),
    "email_address": (
        "business_entity_id long, email_address string, modified_date timestamp_ntz",
        [(11, "old@x.org", D1), (11, "new@x.org", D2)]),
    "person_phone": (
        "business_entity_id long, phone_number string, modified_date timestamp_ntz",
        [(11, "111", D1)]),
    "business_entity_address": (
        "business_entity_id long, address_id long, modified_date timestamp_ntz",
        [(11, 51, D1), (11, 52, D2)]),
    "address": (
        "address_id long, city string, state_province_id long",
        [(51, "Quito", 1), (52, "Cuenca", 2)]),
    "state_province": (
        "state_province_id long, name string, country_region_code string",
        [(1, "Pichincha", "EC"), (2, "Azuay", "EC")]),
    "country_region": ("country_region_code string, name string", [("EC", "Ecuador")]),
    # 102 has no subcategory and no colour
    "product": (
        "product_id long, name string, product_number string, color string, size string,"
        " weight decimal(8,2), standard_cost decimal(10,2), list_price decimal(10,2),"
        " sell_start_date date, sell_end_date date, product_subcategory_id string,"
        " modified_date timestamp_ntz",
        [(101, "Bike", "BK-1", "Red", "L", money("10.50"), money("60.00"), money("100.00"),
          date(2010, 1, 1), None, "s1", D1),
         (102, "Bolt", "BO-1", None, None, None, money("0.10"), money("1.00"),
          date(2010, 1, 1), date(2013, 1, 1), None, D2)]),
    "product_subcategory": (
        "product_subcategory_id string, name string, product_category_id string",
        [("s1", "Road Bikes", "c1")]),
    "product_category": ("product_category_id string, name string", [("c1", "Bikes")]),
    # 22 has no territory; 23 is not an employee
    "sales_person": (
        "business_entity_id long, territory_id long, sales_quota decimal(19,4), bonus decimal(19,4),"
        " commission_pct decimal(5,2), modified_date timestamp_ntz",
        [(21, 1, money("1000"), money("10"), money("0.01"), D1),
         (22, None, None, money("20"), money("0.02"), D1), (23, 1, None, None, None, D1)]),
    "employee": (
        "business_entity_id long, job_title string, hire_date date",
        [(21, "Rep", date(2011, 1, 1)), (22, None, date(2012, 1, 1))]),
    "sales_territory": (
        "territory_id long, name string, country string, group_name string, modified_date timestamp_ntz",
        [(1, "Andes", "Ecuador", "America", D1), (2, None, None, None, D1)]),
    "special_offer": (
        "special_offer_id long, description string, discount_pct decimal(5,4), type string,"
        " category string, start_date date, end_date date, min_qty int, max_qty int,"
        " modified_date timestamp_ntz",
        [(1, "None", money("0.0000"), "No Discount", "No", date(2010, 1, 1), date(2020, 1, 1), 0, None, D1),
         (2, "Volume", money("0.0150"), "Volume", "Reseller", date(2010, 1, 1), date(2020, 1, 1), 10, 20, D1)]),
    # 1002 is a web order without a salesperson
    "sales_order_header": (
        "sales_order_id long, order_date timestamp_ntz, customer_id long, sales_person_id long,"
        " territory_id long",
        [(1001, D1, 1, 21, 1), (1002, D2, 2, None, 2), (1003, D3, 3, 22, 1)]),
    # product 999 of order 1003 is in no product table
    "sales_order_detail": (
        "sales_order_id long, product_id long, special_offer_id long, order_qty int,"
        " unit_price decimal(10,2), unit_price_discount decimal(5,2), line_total decimal(12,2)",
        [(1001, 101, 1, 1, money("100.00"), money("0.00"), money("100.00")),
         (1001, 102, 2, 20, money("1.00"), money("0.02"), money("19.60")),
         (1002, 101, 1, 2, money("100.00"), money("0.00"), money("200.00")),
         (1003, 999, 1, 1, money("5.00"), money("0.00"), money("5.00")),
         (1003, 102, 1, 5, money("1.00"), money("0.00"), money("5.00"))]),
}


def source(spark: SparkSession, **replaced):
    """The tables as DataFrames; ``replaced`` gives other rows for some of them."""
    return {name: spark.createDataFrame(replaced.get(name, rows), schema)
            for name, (schema, rows) in TABLES.items()}
