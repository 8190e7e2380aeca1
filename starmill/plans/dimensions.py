"""What each dimension takes from staging."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from starmill.functions import labels
from starmill.functions.scalars import default_to
from starmill.operators.keys import assign_keys, max_key
from starmill.operators.merge import scd1_merge
from starmill.sources.shared import Scratch


@dataclass(frozen=True)
class Dimension:
    """``attributes`` maps dimension columns to staged ones; ``defaults`` replaces staged NULLs."""

    staging: str
    process: str
    key: str
    business_id: str
    staged_id: str
    attributes: Mapping[str, str]
    defaults: Mapping[str, str] = field(default_factory=dict)

    def source(self, staged: DataFrame, *also: str) -> DataFrame:
        """Distinct staged members, missing labels filled in; with the columns ``also``."""
        return staged.select(self.staged_id, *[self._value(c).alias(c) for c in self.attributes.values()],
                             *also).distinct()

    def observations(self, staged: DataFrame, *also: str) -> DataFrame:
        """Staged members under the dimension's column names, with their modification time."""
        return staged.select(F.col(self.staged_id).alias(self.business_id),
                             *[self._value(s).alias(t) for t, s in self.attributes.items()],
                             "modified_date", *also)

    def _value(self, column: str) -> Column:
        return default_to(column, self.defaults[column]) if column in self.defaults else F.col(column)


DIMENSIONS = {
    "dim_customer": Dimension(
        staging="customer", process=labels.DW_CUSTOMER, key="customer_key",
        business_id="customer_id_source", staged_id="customer_id",
        attributes={"full_name": "full_name", "email": "email", "customer_type": "customer_type",
                    "territory_id_source": "territory_id"}),
    "dim_product": Dimension(
        staging="product", process=labels.DW_PRODUCT, key="product_key",
        business_id="product_id_source", staged_id="product_id",
        attributes={"product_name": "product_name", "color": "color", "subcategory": "subcategory",
                    "category": "category"}),
    "dim_promotion": Dimension(
        staging="promotion", process=labels.DW_PROMOTION, key="promotion_key",
        business_id="promotion_id_source", staged_id="promotion_id",
        attributes={"promotion_name": "promotion_name", "promotion_type": "promotion_type",
                    "discount_pct": "discount_pct", "start_date": "start_date",
                    "end_date": "end_date"}),
    "dim_territory": Dimension(
        staging="territory", process=labels.DW_TERRITORY, key="territory_key",
        business_id="territory_id_source", staged_id="territory_id",
        attributes={"territory_name": "territory_name", "country": "country_name",
                    "group_name": "group_name"},
        defaults={"territory_name": labels.NO_NAME, "country_name": labels.NO_COUNTRY,
                  "group_name": labels.NO_GROUP}),
    "dim_salesperson": Dimension(
        staging="salesperson", process=labels.DW_SALESPERSON, key="salesperson_key",
        business_id="salesperson_id_source", staged_id="salesperson_id",
        attributes={"full_name": "full_name", "job_title": "job_title",
                    "territory_id_source": "territory_id"},
        defaults={"full_name": labels.NO_NAME, "job_title": labels.NO_JOB}),
}

def merge_dimension(dim: Dimension, target: DataFrame, source: DataFrame,
                    stamps: Mapping[str, object], scratch: Scratch | None = None,
                    null_safe: bool = True, collation: str | None = None,
                    broadcast_source: bool | None = None, last_key: int | None = None) -> DataFrame:
    """The dimension after one load, with the ``action`` taken for each member.

    New members get the keys after the greatest one in use, in the order of their business id.
    ``last_key`` tells that key where ``target`` is a part of the dimension.
    """
    merge = scd1_merge(target, source, {dim.business_id: dim.staged_id}, dim.attributes,
                       stamps=stamps, null_safe=null_safe, collation=collation,
                       broadcast_source=broadcast_source)
    new = assign_keys(merge.new.drop(dim.key), [dim.business_id], dim.key,
                      start=max_key(target, dim.key) if last_key is None else last_key, scratch=scratch)
    return merge.existing.unionByName(new)


def inferred_members(dim: Dimension, ids: DataFrame, like: DataFrame, stamps: Mapping[str, object],
                     last_key: int, scratch: Scratch) -> DataFrame:
    """Placeholder rows, columns as in ``like``, for business ids that no load has brought yet.

    Texts hold a label, so that a merge that takes NULL for equal to everything updates them too.
    """
    columns = {dim.business_id: F.col("_id")}
    for attribute in dim.attributes:
        text = isinstance(like.schema[attribute].dataType, StringType)
        columns[attribute] = F.lit(dim.defaults.get(attribute, labels.NO_NAME) if text else None)
    columns |= {c: F.lit(v) for c, v in stamps.items()}
    rows = ids.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in like.schema.fields if f.name != dim.key])
    return assign_keys(rows, [dim.business_id], dim.key, start=last_key, scratch=scratch)


# Seed row for sales without a salesperson. Its business id occurs in no source, so no merge
# ever matches it.
UNKNOWN_SALESPERSON = {
    "salesperson_key": labels.UNKNOWN_KEY,
    "salesperson_id_source": labels.UNKNOWN_KEY,
    "full_name": labels.UNKNOWN_SALESPERSON,
    "job_title": labels.UNKNOWN_JOB,
}
