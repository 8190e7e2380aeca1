"""The sales fact: key lookups and idempotent append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.functions.labels import UNKNOWN_KEY
from starmill.functions.scalars import date_key
from starmill.operators.history import point_in_time
from starmill.sources.shared import Scratch

FACT_COLUMNS = ["date_key", "product_key", "customer_key", "salesperson_key", "territory_key",
                "promotion_key", "sales_order_id", "order_qty", "unit_price",
                "unit_price_discount", "line_total"]
MEASURES = ["order_qty", "unit_price", "unit_price_discount", "line_total"]
FACT_KEY = ["sales_order_id", "product_key"]
LINE_KEY = ["sales_order_id", "product_id"]
VERSION_KEY = "version_key"
# A lookup that leaves a NULL key, for a later step to decide about.
NULL = "null"


@dataclass(frozen=True)
class Lookup:
    """One dimension lookup: the line column that holds the business id, and what a miss means.

    A dimension that ``grows`` with the sales is never gathered on the driver to be broadcast.
    """

    dimension: str
    line_column: str
    business_id: str
    key: str
    on_missing: str  # "drop", "unknown" or (in a warehouse) "infer"
    grows: bool = False


LOOKUPS = (
    Lookup("dim_date", "date_key", "date_key", "date_key", "drop"),
    Lookup("dim_product", "product_id", "product_id_source", "product_key", "drop", grows=True),
    Lookup("dim_customer", "customer_id", "customer_id_source", "customer_key", "drop", grows=True),
    Lookup("dim_salesperson", "sales_person_id", "salesperson_id_source", "salesperson_key", "unknown"),
    Lookup("dim_territory", "territory_id", "territory_id_source", "territory_key", "drop"),
    Lookup("dim_promotion", "special_offer_id", "promotion_id_source", "promotion_key", "drop"),
)


class DuplicateLines(ValueError):
    """Several lines of a batch share order and product."""


def look_up(lines: DataFrame, dimension: DataFrame, lookup: Lookup) -> DataFrame:
    """Add the surrogate key.

    The side of a dimension that grows is shuffled, others are left to the planner: the snapshot's file
    size decides between a broadcast and a shuffle. A hot member is split by the adaptive skew join.
    """
    right = dimension.select(F.col(lookup.business_id).alias("_id"),
                             F.col(lookup.key).alias("_key"))
    if lookup.grows:
        right = right.hint("shuffle_hash")
    how = "inner" if lookup.on_missing == "drop" else "left"
    joined = lines.join(right, lines[lookup.line_column] == F.col("_id"), how)
    key = F.col("_key") if lookup.on_missing in ("drop", NULL) else F.coalesce("_key", F.lit(UNKNOWN_KEY))
    kept = [c for c in lines.columns if c != lookup.key]
    return joined.select(*kept, key.alias(lookup.key))


def order_lines(detail: DataFrame, header: DataFrame, sales_person: Column | None = None) -> DataFrame:
    """Detail joined with header, with the date key; ``sales_person`` overrides the header's column."""
    lines = detail.join(header, "sales_order_id").withColumn("date_key", date_key("order_date"))
    return lines if sales_person is None else lines.withColumn("sales_person_id", sales_person)


def header_keys(header: DataFrame, dims: Mapping[str, DataFrame], lookups: dict[str, Lookup],
                versions: Sequence[str] = (), drop: bool = True) -> DataFrame:
    """Headers with the key of their customer, whose lookup is taken out of ``lookups``.

    There are fewer orders than lines, and they may be laid out by customer already. An inferred or versioned
    customer is left to the lines. Without ``drop`` a customer that should drop an order leaves a NULL key.
    """
    customer = lookups["dim_customer"]
    if customer.dimension in versions or customer.on_missing == "infer":
        return header
    del lookups["dim_customer"]
    if customer.on_missing == "drop" and not drop:
        customer = replace(customer, on_missing=NULL)
    return look_up(header, dims[customer.dimension], customer)


def lookups_with(on_missing: Mapping[str, str] | None) -> dict[str, Lookup]:
    """The lookups by dimension, with the policies of ``on_missing``."""
    policy = dict(on_missing or {})
    return {l.dimension: replace(l, on_missing=policy.get(l.dimension, l.on_missing)) for l in LOOKUPS}


def new_lines(lines: DataFrame, existing: DataFrame | None, duplicates: str,
              line_order: Sequence[str] = ()) -> DataFrame:
    """Lines that ``existing`` (order and source product id) does not hold, by the policy for ``duplicates``.

    Order and source product id identify a line, also where the product is in no dimension.
    """
    if existing is not None:
        held = existing.select(F.col("sales_order_id").alias("_order"), F.col("product_id_source").alias("_product"))
        # A line without a product id is known by its order.
        same = (F.col("sales_order_id") == F.col("_order")) & F.col("product_id").eqNullSafe(F.col("_product"))
        lines = lines.join(held, same, "left_anti")
    if duplicates == "error":
        check_duplicates(lines)
    elif duplicates == "first":
        # Most keys have one line, so sorting within the tasks of a scan, whose files unfold to many times
        # their size, would cut nothing: lines are sorted in partitions of the shuffle only.
        lines = first_of_each(lines.repartition(*LINE_KEY), line_order)
    return lines


def first_of_each(lines: DataFrame, line_order: Sequence[str], key: Sequence[str] = LINE_KEY) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*line_order))
    return lines.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def look_up_version(lines: DataFrame, versions: DataFrame, lookup: Lookup, version_key: str = VERSION_KEY,
                    scratch: Scratch | None = None) -> DataFrame:
    """Add the key of the version that was valid on the order's date.

    ``versions`` is a type 2 dimension, with the business id, ``valid_from``, ``valid_to`` and ``version_key``.
    """
    named = versions.select(F.col(lookup.business_id).alias(lookup.line_column), "valid_from", "valid_to",
                            F.col(version_key).alias("_version_key"))
    kept = [c for c in lines.columns if c != lookup.key]
    found = point_in_time(lines.select(*kept), named, [lookup.line_column], "order_date", ["_version_key"],
                          scratch=scratch)
    if lookup.on_missing == "drop":
        found = found.where("_version_key IS NOT NULL")
    return found.select(*kept, F.coalesce("_version_key", F.lit(UNKNOWN_KEY)).alias(lookup.key))


def with_keys(lines: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup],
              versions: Mapping[str, DataFrame] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """All lookups one after the other; those of dimensions in ``versions`` by the order's date."""
    for lookup in lookups:
        if versions and lookup.dimension in versions:
            lines = look_up_version(lines, versions[lookup.dimension], lookup, scratch=scratch)
        else:
            lines = look_up(lines, dims[lookup.dimension], lookup)
    return lines


def without_place(lines: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup]) -> DataFrame:
    """Orders with a line that a lookup drops, each once."""
    missing = [lines.join(dims[l.dimension], lines[l.line_column] == dims[l.dimension][l.business_id], "left_anti")
               .select("sales_order_id") for l in lookups if l.on_missing == "drop"]
    return reduce(DataFrame.unionByName, missing).distinct()


def load_fact(detail: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame], *,
              existing: DataFrame | None = None, duplicates: str = "keep",
              line_order: Sequence[str] = (), sales_person: Column | None = None,
              on_missing: Mapping[str, str] | None = None,
              versions: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Fact rows for the lines of ``detail`` that ``existing`` does not hold yet.

    Known lines are discarded before anything else is joined: in a repeated or incremental load only
    new lines reach the lookups and the header join. ``existing`` is compared by source product id where
    it has one (``product_id_source``), which also tells unknown products apart, else by key, or by the
    source id of its key where lines without a product are dropped. ``duplicates`` says what to do with
    new lines that share order and product: ``keep`` them, take the ``first`` by
    ``line_order``, or fail (``error``; see ``check_duplicates``). ``on_missing`` overrides the
    policy of a dimension. Dimensions in ``versions`` are type 2; their key is that of the
    version valid on the order's date.
    """
    lookups = lookups_with(on_missing)
    if existing is not None and "product_id_source" in existing.columns:
        lines = look_up(new_lines(detail, existing, duplicates, line_order), dims["dim_product"],
                        lookups.pop("dim_product"))
    elif lookups["dim_product"].on_missing == "drop" and duplicates != "error":
        product = lookups.pop("dim_product")
        lines = detail if duplicates != "first" else first_of_each(detail, line_order)
        if existing is not None:
            # The stored keys are turned into source ids, since they are narrower than the lines.
            ids = dims["dim_product"].select(product.key, F.col(product.business_id).alias(product.line_column))
            held = existing.select(*FACT_KEY).join(ids.hint("shuffle_hash"), product.key).select(*LINE_KEY)
            lines = lines.join(held, LINE_KEY, "left_anti")
        lines = look_up(lines, dims["dim_product"], product)
    else:
        product = lookups.pop("dim_product")
        lines = look_up(detail, dims["dim_product"], product)
        if duplicates == "first":
            lines = first_of_each(lines, line_order)
        if existing is not None:
            lines = lines.join(existing.select(*FACT_KEY), FACT_KEY, "left_anti")
        if duplicates == "error":
            check_duplicates(lines)
    lines = order_lines(lines, header_keys(header, dims, lookups, versions or ()), sales_person)
    return with_keys(lines, dims, list(lookups.values()), versions).select(*FACT_COLUMNS)


def check_duplicates(lines: DataFrame) -> None:
    clash = lines.groupBy(*LINE_KEY).agg(F.count("*").alias("rows")).where("rows > 1").first()
    if clash is not None:
        raise DuplicateLines(f"order {clash['sales_order_id']} holds product "
                             f"{clash['product_id']} on {clash['rows']} lines")
