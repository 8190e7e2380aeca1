"""Order-system tables in the roles the loads expect.

The loads name their source tables after a sales order system (header, detail, customer, person,
product, special offer, ...). This module builds those roles from the generic tables
``region nation customer supplier part orders lineitem events``. Modification times are the
latest related order, shipment or event.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from starmill.functions.scalars import time_literal
from starmill.sources.tables import OpenOnUse

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

Tables = Mapping[str, DataFrame]

# Order in which lines that share order and product are considered.
LINE_ORDER = ["l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _beginning() -> Column:
    return time_literal(datetime(1995, 1, 1))


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def line_total() -> Column:
    """Price after discount. Money is made decimal before any arithmetic."""
    rate = F.lit(1).cast("decimal(5,2)") - F.col("l_discount").cast("decimal(5,2)")
    return (money("l_extendedprice") * rate).cast("decimal(12,2)")


def unit_price() -> Column:
    """Price per unit, rounded half up; the division is done on whole cents."""
    qty = F.col("l_quantity").cast("long")
    cents = (money("l_extendedprice") * 100).cast("long")
    price_cents = F.call_function("div", 2 * cents + qty, 2 * qty).cast("decimal(10,0)")
    return (price_cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")


def promotion_id() -> Column:
    return F.round(F.col("l_discount") * 100).cast("long")


def sales_person() -> Column:
    """Orders of the lowest priority stand for web orders, which have no salesperson."""
    return F.when(F.col("order_priority") != "5-LOW", F.col("seller_id"))


def order_header(t: Tables) -> DataFrame:
    """Order headers; the territory of an order is that of its customer."""
    return (t["orders"].join(t["customer"].hint("shuffle_hash"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("sales_order_id"),
                    F.col("o_orderdate").alias("order_date"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("c_nationkey").cast("long").alias("territory_id"),
                    F.col("o_orderpriority").alias("order_priority")))


def order_detail(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").alias("sales_order_id"),
        F.col("l_partkey").alias("product_id"),
        promotion_id().alias("special_offer_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").cast("int").alias("order_qty"),
        unit_price().alias("unit_price"),
        F.col("l_discount").cast("decimal(5,2)").alias("unit_price_discount"),
        line_total().alias("line_total"),
        *LINE_ORDER)


def _users(t: Tables) -> DataFrame:
    return t["events"].select("user_id").distinct()


def customer(t: Tables) -> DataFrame:
    """Customers that appear among the event users are persons, the others companies."""
    ordered = t["orders"].groupBy("o_custkey").agg(F.max("o_orderdate").alias("_last"))
    return (t["customer"].join(_users(t), F.col("c_custkey") == F.col("user_id"), "left")
            .join(ordered, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("user_id").alias("person_id"),
                    F.col("c_nationkey").cast("long").alias("territory_id"),
                    F.coalesce("_last", _beginning()).alias("modified_date")))


def person(t: Tables) -> DataFrame:
    """Customers in debt have no first name on record."""
    known = t["customer"].join(_users(t), F.col("c_custkey") == F.col("user_id"), "left_semi")
    name = F.split("c_name", "#")
    return known.select(
        F.col("c_custkey").alias("business_entity_id"),
        F.when(F.col("c_acctbal") >= 0, name[0]).alias("first_name"),
        name[1].alias("last_name"))


def _contact(t: Tables, kind: str, name: str, value: Column) -> DataFrame:
    """Events of one type as contact rows of their user, many per user."""
    return t["events"].where(F.col("event_type") == kind).select(
        F.col("user_id").alias("business_entity_id"), value.alias(name),
        F.col("ts").alias("modified_date"))


def email_address(t: Tables) -> DataFrame:
    event = F.col("event_id").cast("string")
    return _contact(t, "signup", "email_address",
                    F.concat(F.lit("user"), event, F.lit("@example.com")))


def person_phone(t: Tables) -> DataFrame:
    return _contact(t, "click", "phone_number",
                    F.concat(F.lit("555-"), F.col("event_id").cast("string")))


def business_entity_address(t: Tables) -> DataFrame:
    return _contact(t, "purchase", "address_id", F.col("event_id"))


def address(t: Tables) -> DataFrame:
    return (t["events"].where(F.col("event_type") == "purchase")
            .join(t["customer"], F.col("user_id") == F.col("c_custkey"))
            .select(F.col("event_id").alias("address_id"),
                    F.concat(F.lit("City "), F.col("user_id").cast("string")).alias("city"),
                    F.col("c_nationkey").alias("state_province_id")))


def state_province(t: Tables) -> DataFrame:
    return t["nation"].select(
        F.col("n_nationkey").alias("state_province_id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("country_region_code"))


def country_region(t: Tables) -> DataFrame:
    return t["region"].select(
        F.col("r_regionkey").cast("string").alias("country_region_code"), F.col("r_name").alias("name"))


def product(t: Tables) -> DataFrame:
    shipped = t["lineitem"].groupBy("l_partkey").agg(
        F.min("l_shipdate").alias("_first"), F.max("l_shipdate").alias("_last"))
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return t["part"].join(shipped, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("PN-"), F.col("p_partkey").cast("string")).alias("product_number"),
        F.nullif(F.split("p_name", " ")[0], F.lit("small")).alias("color"),
        F.col("p_size").cast("string").alias("size"),
        (F.col("p_size") * F.lit("1.5").cast("decimal(3,2)")).cast("decimal(8,2)").alias("weight"),
        (price * F.lit("0.60").cast("decimal(3,2)")).cast("decimal(10,2)").alias("standard_cost"),
        price.alias("list_price"),
        F.col("_first").cast("date").alias("sell_start_date"),
        F.when(F.col("p_size") > 40, F.col("_last").cast("date")).alias("sell_end_date"),
        F.when(F.col("p_brand") != "Brand#1", _subcategory_id()).alias("product_subcategory_id"),
        F.coalesce("_last", _beginning()).alias("modified_date"))


def _subcategory_id() -> Column:
    return F.concat_ws("/", "p_type", "p_brand")


def product_subcategory(t: Tables) -> DataFrame:
    return t["part"].select("p_type", "p_brand").distinct().select(
        _subcategory_id().alias("product_subcategory_id"),
        F.col("p_brand").alias("name"),
        F.nullif("p_type", F.lit("SMALL")).alias("product_category_id"))


def product_category(t: Tables) -> DataFrame:
    return t["part"].select("p_type").distinct().select(
        F.col("p_type").alias("product_category_id"), F.col("p_type").alias("name"))


def _sellers(t: Tables) -> DataFrame:
    """Suppliers that have sold something, with their first and last shipment."""
    sold = t["lineitem"].groupBy("l_suppkey").agg(
        F.min("l_shipdate").alias("_first"), F.max("l_shipdate").alias("_last"))
    return t["supplier"].join(sold, F.col("s_suppkey") == F.col("l_suppkey"))


def sales_person_role(t: Tables) -> DataFrame:
    balance = F.col("s_acctbal")
    return _sellers(t).select(
        F.col("s_suppkey").alias("business_entity_id"),
        F.nullif(F.col("s_nationkey").cast("long"), F.lit(0)).alias("territory_id"),
        F.when(balance >= 0, balance).cast("decimal(19,4)").alias("sales_quota"),
        balance.cast("decimal(19,4)").alias("bonus"),
        F.lit("0.01").cast("decimal(5,2)").alias("commission_pct"),
        F.col("_last").alias("modified_date"))


def employee(t: Tables) -> DataFrame:
    balance = F.col("s_acctbal")
    job = F.when(balance < 0, None).when(balance < 5000, "REP").otherwise("MANAGER")
    return _sellers(t).select(
        F.col("s_suppkey").alias("business_entity_id"), job.alias("job_title"),
        F.col("_first").cast("date").alias("hire_date"))


def seller(t: Tables) -> DataFrame:
    name = F.split("s_name", "#")
    return t["supplier"].select(
        F.col("s_suppkey").alias("business_entity_id"),
        name[0].alias("first_name"), name[1].alias("last_name"))


def sales_territory(t: Tables) -> DataFrame:
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("territory_id"), F.col("n_name").alias("name"),
        F.col("n_name").alias("country"), F.col("r_name").alias("group_name"),
        _beginning().alias("modified_date"))


def special_offer(t: Tables) -> DataFrame:
    """One offer per discount step, valid from its first to its last use."""
    offer = F.col("special_offer_id")
    used = t["lineitem"].groupBy(promotion_id().alias("special_offer_id")).agg(
        F.min("l_shipdate").alias("_first"), F.max("l_shipdate").alias("_last"),
        F.min("l_quantity").cast("int").alias("min_qty"),
        F.max("l_quantity").cast("int").alias("max_qty"))
    return used.select(
        offer,
        F.concat(F.lit("Discount "), offer.cast("string"), F.lit("%")).alias("description"),
        (offer.cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(5,4)").alias("discount_pct"),
        F.when(offer == 0, "No Discount").otherwise("Volume Discount").alias("type"),
        F.lit("Customer").alias("category"),
        F.col("_first").cast("date").alias("start_date"),
        F.col("_last").cast("date").alias("end_date"),
        "min_qty", "max_qty", F.col("_last").alias("modified_date"))


ROLES: dict[str, Callable[[Tables], DataFrame]] = {
    "customer": customer,
    "person": person,
    "email_address": email_address,
    "person_phone": person_phone,
    "business_entity_address": business_entity_address,
    "address": address,
    "state_province": state_province,
    "country_region": country_region,
    "product": product,
    "product_subcategory": product_subcategory,
    "product_category": product_category,
    "sales_person": sales_person_role,
    "employee": employee,
    "seller": seller,
    "sales_territory": sales_territory,
    "special_offer": special_offer,
    "sales_order_header": order_header,
    "sales_order_detail": order_detail,
}


def source_roles(tables: Tables) -> OpenOnUse:
    """Every role over a set of tables."""
    return OpenOnUse({name: partial(role, tables) for name, role in ROLES.items()})
