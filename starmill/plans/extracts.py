"""Extracts: normalised source tables to one staging row per entity.

``src`` maps source table names to DataFrames. Each extract filters its driving table on the
modification time before the first join, so the filter reaches that table's scan. ``lookback``
re-reads a span before the watermark for rows that arrived late. With ``changed``, the time up to
which each joined table was followed, members that a later change of a joined table touches are
extracted as well, and ``modified_date`` is the latest time of all rows that a member is made of.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from starmill.functions.labels import COMPANY, FIRST_WATERMARK, NO_CATEGORY, NO_COLOR, NO_SUBCATEGORY, PERSON
from starmill.functions.scalars import default_to, null_tolerant_concat, time_literal
from starmill.operators.incremental import incremental
from starmill.operators.lookup import one_per_key

Sources = Mapping[str, DataFrame]

NONE = timedelta(0)


@dataclass(frozen=True)
class Followed:
    """A joined table whose changes count as changes of the entity.

    From its ``key`` the ``hops`` (table, column met, column gone on with) lead to ids of the driving
    table's ``column``.
    """

    table: str
    key: str
    column: str
    hops: tuple[tuple[str, str, str], ...] = ()


_TO_PERSON = ("business_entity_address", "address_id", "business_entity_id")
_TO_ADDRESS = ("address", "state_province_id", "address_id")

DRIVING = {"customer": "customer", "product": "product", "salesperson": "sales_person",
           "promotion": "special_offer", "territory": "sales_territory"}

FOLLOWED = {
    "customer": (
        *[Followed(t, "business_entity_id", "person_id")
          for t in ("person", "email_address", "person_phone", "business_entity_address")],
        Followed("address", "address_id", "person_id", (_TO_PERSON,)),
        Followed("state_province", "state_province_id", "person_id", (_TO_ADDRESS, _TO_PERSON)),
        Followed("country_region", "country_region_code", "person_id",
                 (("state_province", "country_region_code", "state_province_id"), _TO_ADDRESS, _TO_PERSON))),
    "product": (
        Followed("product_subcategory", "product_subcategory_id", "product_subcategory_id"),
        Followed("product_category", "product_category_id", "product_subcategory_id",
                 (("product_subcategory", "product_category_id", "product_subcategory_id"),))),
    "salesperson": (
        *[Followed(t, "business_entity_id", "business_entity_id") for t in ("employee", "person", "seller")],
        Followed("sales_territory", "territory_id", "territory_id")),
}


def followed(entity: str, src: Sources) -> list[Followed]:
    """The joined tables of ``entity`` that tell when their rows changed."""
    return [f for f in FOLLOWED.get(entity, ()) if f.table in src and "modified_date" in src[f.table].columns]


def _changed_ids(src: Sources, table: Followed, since: datetime) -> DataFrame:
    """Ids of the driving table's column that rows changed after ``since`` lead to."""
    ids = incremental(src[table.table], "modified_date", since).select(F.col(table.key).alias("_id")).distinct()
    for name, met, goes_on in table.hops:
        ids = src[name].join(ids, src[name][met] == F.col("_id"), "left_semi").select(
            F.col(goes_on).alias("_id")).distinct()
    return ids


def driving_rows(entity: str, src: Sources, last: datetime, lookback: timedelta = NONE,
                 changed: Mapping[str, datetime] | None = None) -> DataFrame:
    """Rows of the driving table that are new themselves or that a changed row of a joined table touches.

    ``changed`` gives the time each joined table was followed up to. The changed rows are few, so the
    joins that look for the rows they touch are semi-joins with a small side.
    """
    table = src[DRIVING[entity]]
    found = incremental(table, "modified_date", last, lookback)
    if not changed:
        return found
    newer = F.col("modified_date") > time_literal(last - lookback)
    rest = table.where(newer.isNull() | ~newer)
    by_column: dict[str, DataFrame] = {}
    for link in followed(entity, src):
        if link.table in changed:
            ids = _changed_ids(src, link, changed[link.table])
            by_column[link.column] = by_column[link.column].union(ids) if link.column in by_column else ids
    for column, ids in by_column.items():
        same = rest[column] == F.col("_id")
        found, rest = found.unionByName(rest.join(ids, same, "left_semi")), rest.join(ids, same, "left_anti")
    return found


def _changed_at(df: DataFrame, name: str) -> DataFrame:
    """``df`` with its modification time, if it has one, under a name of its own."""
    return df.withColumnRenamed("modified_date", f"_changed_{name}")


def _latest(joined: DataFrame, own: str, follow: bool) -> Column:
    """When a row or, if they are followed, any joined row of it changed last."""
    times = [c for c in joined.columns if c.startswith("_changed_")] if follow else []
    return F.greatest(own, *times).alias("modified_date") if times else F.col(own)


def _contact(df: DataFrame, name: str, column: str) -> DataFrame:
    """The newest contact row of each person, so the join below cannot multiply customers."""
    newest = one_per_key(df.select("business_entity_id", "modified_date", column),
                         ["business_entity_id"], ["modified_date"])
    return _changed_at(newest, name)


def extract_customer(src: Sources, last: datetime, lookback: timedelta = NONE,
                     changed: Mapping[str, datetime] | None = None) -> DataFrame:
    """Customers with the name, newest contact and place of their person.

    Everything about a person is joined first, all on the person's id, so those joins share one
    partitioning; past the first load only rows of the batch's persons are taken that far. Companies, which
    have no person, do not take part in the join.
    """
    customers = driving_rows("customer", src, last, lookback, changed)
    persons = customers.where(F.col("person_id").isNotNull())
    batch = None if last == FIRST_WATERMARK else persons.select(F.col("person_id").alias("_of_batch")).distinct()

    def of_batch(df: DataFrame) -> DataFrame:
        return df if batch is None else df.join(batch, df["business_entity_id"] == F.col("_of_batch"), "left_semi")

    place = (
        _contact(of_batch(src["business_entity_address"]), "entity_address", "address_id")
        .join(_changed_at(src["address"], "address"), "address_id", "left")
        .join(_changed_at(src["state_province"], "province").withColumnRenamed("name", "state_province"),
              "state_province_id", "left")
        .join(_changed_at(src["country_region"], "country").withColumnRenamed("name", "country"),
              "country_region_code", "left"))
    place = place.select("business_entity_id", "city", "state_province", "country",
                         *[c for c in place.columns if c.startswith("_changed_")])
    people = (
        _changed_at(of_batch(src["person"]), "person")
        .join(_contact(of_batch(src["email_address"]), "email", "email_address"), "business_entity_id", "left")
        .join(_contact(of_batch(src["person_phone"]), "phone", "phone_number"), "business_entity_id", "left")
        .join(place, "business_entity_id", "left"))
    joined = persons.join(people, persons["person_id"] == people["business_entity_id"], "left")
    companies = customers.where(F.col("person_id").isNull())
    joined = joined.unionByName(companies, allowMissingColumns=True)
    return joined.select(
        "customer_id",
        "person_id",
        F.when(F.col("person_id").isNotNull(), PERSON).otherwise(COMPANY).alias("customer_type"),
        null_tolerant_concat("first_name", "last_name").alias("full_name"),
        F.col("email_address").alias("email"),
        F.col("phone_number").alias("phone"),
        "city",
        "state_province",
        "country",
        "territory_id",
        _latest(joined, "modified_date", changed is not None))


def extract_product(src: Sources, last: datetime, lookback: timedelta = NONE,
                    changed: Mapping[str, datetime] | None = None) -> DataFrame:
    p = driving_rows("product", src, last, lookback, changed).alias("p")
    s = _changed_at(src["product_subcategory"], "subcategory").alias("s")
    c = _changed_at(src["product_category"], "category").alias("c")
    joined = (
        p.join(s, F.col("p.product_subcategory_id") == F.col("s.product_subcategory_id"), "left")
        .join(c, F.col("s.product_category_id") == F.col("c.product_category_id"), "left"))
    return joined.select(
        "p.product_id",
        F.col("p.name").alias("product_name"),
        "p.product_number",
        default_to("p.color", NO_COLOR).alias("color"),
        "p.size",
        "p.weight",
        default_to("s.name", NO_SUBCATEGORY).alias("subcategory"),
        default_to("c.name", NO_CATEGORY).alias("category"),
        "p.standard_cost",
        "p.list_price",
        "p.sell_start_date",
        "p.sell_end_date",
        _latest(joined, "p.modified_date", changed is not None))


def extract_salesperson(src: Sources, last: datetime, lookback: timedelta = NONE,
                        changed: Mapping[str, datetime] | None = None) -> DataFrame:
    """Salespersons that are employees and persons; the territory is optional.

    Persons come from ``seller`` where the source keeps salespersons apart from customers.
    """
    sp = driving_rows("salesperson", src, last, lookback, changed).alias("sp")
    person = src["seller"] if "seller" in src else src["person"]
    e, p = _changed_at(src["employee"], "employee").alias("e"), _changed_at(person, "person").alias("p")
    t = _changed_at(src["sales_territory"], "territory").alias("t")
    joined = (
        sp.join(e, F.col("sp.business_entity_id") == F.col("e.business_entity_id"))
        .join(p, F.col("sp.business_entity_id") == F.col("p.business_entity_id"))
        .join(t, F.col("sp.territory_id") == F.col("t.territory_id"), "left"))
    return joined.select(
        F.col("sp.business_entity_id").alias("salesperson_id"),
        null_tolerant_concat("p.first_name", "p.last_name").alias("full_name"),
        "e.job_title",
        "e.hire_date",
        "t.territory_id",
        F.col("t.name").alias("territory_name"),
        "sp.sales_quota",
        "sp.bonus",
        "sp.commission_pct",
        _latest(joined, "sp.modified_date", changed is not None))


def extract_promotion(src: Sources, last: datetime, lookback: timedelta = NONE,
                      changed: Mapping[str, datetime] | None = None) -> DataFrame:
    return driving_rows("promotion", src, last, lookback).select(
        F.col("special_offer_id").alias("promotion_id"),
        F.col("description").alias("promotion_name"),
        "discount_pct",
        F.col("type").alias("promotion_type"),
        "category",
        "start_date",
        "end_date",
        "min_qty",
        "max_qty",
        "modified_date")


def extract_territory(src: Sources, last: datetime, lookback: timedelta = NONE,
                      changed: Mapping[str, datetime] | None = None) -> DataFrame:
    return driving_rows("territory", src, last, lookback).select(
        "territory_id",
        F.col("name").alias("territory_name"),
        F.col("country").alias("country_name"),
        "group_name",
        "modified_date")


EXTRACTS = {
    "customer": extract_customer,
    "product": extract_product,
    "salesperson": extract_salesperson,
    "promotion": extract_promotion,
    "territory": extract_territory,
}
