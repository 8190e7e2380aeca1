"""Type 1 merge: overwrite changed attributes, insert new members, never delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from starmill.functions.scalars import any_differs, sql_literal

# A source whose files hold at most this many bytes is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 8 << 20


class AmbiguousSource(ValueError):
    """Two source rows would update the same dimension member."""


def _mapping(columns: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}


def ambiguous_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur on more than one source row, with the number of rows."""
    return source.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def count_unambiguous(source: DataFrame, keys: Sequence[str]) -> int:
    """Number of source rows; raises when a key occurs on more than one of them."""
    per_key = source.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = per_key.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count("*")).first()
    if total[0] != total[1]:
        clash = ambiguous_keys(source, keys).first()
        raise AmbiguousSource(f"{clash['rows']} source rows for {[clash[k] for k in keys]}")
    return total[0]


@dataclass(frozen=True)
class Merge:
    """Outcome of a merge.

    ``table`` is the whole result; ``existing`` and ``new`` are its two halves, for loads that
    still have to give the new members their surrogate keys.
    """

    table: DataFrame
    existing: DataFrame
    new: DataFrame


def scd1_merge(target: DataFrame, source: DataFrame, keys: Sequence[str] | Mapping[str, str],
               attributes: Sequence[str] | Mapping[str, str], *, stamps: Mapping[str, object],
               null_safe: bool = True, collation: str | None = None,
               newer_by: str | Sequence[str] = (), broadcast_source: bool | None = None) -> Merge:
    """Match ``source`` to ``target`` on ``keys`` and decide an ``action`` for each row.

    ``keys`` and ``attributes`` map target columns to source columns. A matched row is an
    ``update`` when an attribute changed and a ``keep`` otherwise; an unmatched source row is an
    ``insert``; target rows without a source row are kept. ``stamps`` (load time, user) are
    written on updates and inserts. With ``newer_by`` an update also needs greater values in
    these columns, compared one after the other, which makes batches safe to repeat and to reorder.
    Other target columns, the surrogate key among them, are NULL on inserts. Strings are compared byte by byte unless a
    ``collation`` is named, such as ``UTF8_LCASE_RTRIM`` to ignore case and trailing blanks.

    ``broadcast_source`` picks the join: a small batch is broadcast and the target is never
    shuffled (True); one full outer join on the key shuffles each side once (False). ``None`` takes
    the joins of the first way and leaves it to the planner, which knows sizes, whether to broadcast.
    """
    keys, attributes = _mapping(keys), _mapping(attributes)
    newer_by = [newer_by] if isinstance(newer_by, str) else list(newer_by)
    for column in newer_by:
        attributes.setdefault(column, column)
    small = F.broadcast if broadcast_source else (lambda frame: frame)

    # Written as SQL text: a merge has several expressions per column, and text reaches the JVM
    # in one call.
    incoming = source.selectExpr(
        *[f"`{s}` AS `_key_{t}`" for t, s in keys.items()],
        *[f"`{s}` AS `_new_{t}`" for t, s in attributes.items()],
        "true AS _in_source")
    current = target.selectExpr("*", "true AS _in_target")
    same_key = [F.col(t) == F.col(f"_key_{t}") for t in keys]
    compare = "NOT ({0} <=> {1})" if null_safe else "coalesce({0} <> {1}, false)"

    def operands(name: str) -> list[str]:
        collated = collation is not None and isinstance(target.schema[name].dataType, StringType)
        return [f"`{c}` COLLATE {collation}" if collated else f"`{c}`" for c in (name, f"_new_{name}")]

    changed = " OR ".join(compare.format(*operands(t)) for t in attributes)
    if newer_by:
        stored, offered = (", ".join(f"`{prefix}{c}`" for c in newer_by) for prefix in ("", "_new_"))
        changed = (f"({changed}) AND coalesce(`{newer_by[0]}` IS NULL"
                   f" OR struct({offered}) > struct({stored}), false)")

    def settle(frame: DataFrame) -> DataFrame:
        decided = frame.selectExpr(
            "*", f"CASE WHEN _in_target IS NULL THEN 'insert'"
                 f" WHEN _in_source AND ({changed}) THEN 'update' ELSE 'keep' END AS action")
        columns = []
        for field in target.schema.fields:
            name, value = f"`{field.name}`", f"`{field.name}`"
            if field.name in keys:
                value = f"coalesce({name}, `_key_{field.name}`)"
            elif field.name in attributes:
                value = f"if(action = 'keep', {name}, `_new_{field.name}`)"
            elif field.name in stamps:
                value = f"if(action = 'keep', {name}, {sql_literal(stamps[field.name])})"
            columns.append(f"CAST({value} AS {field.dataType.simpleString()}) AS {name}")
        return decided.selectExpr(*columns, "action")

    if broadcast_source is False:
        both = current.join(incoming, same_key, "full_outer")
        return Merge(
            table=settle(both),
            existing=settle(both.where("_in_target IS NOT NULL")),
            new=settle(both.where("_in_target IS NULL AND _in_source IS NOT NULL")))

    batch = small(incoming)
    existing = settle(current.join(batch, same_key, "left"))
    # Keys found in the target are at most the keys of the batch, so they are small as well.
    found = current.select(*keys).join(batch, same_key, "left_semi")
    unmatched = incoming.join(small(found), same_key, "left_anti").selectExpr(
        "*", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in current.schema.fields])
    new = settle(unmatched)
    return Merge(table=existing.unionByName(new), existing=existing, new=new)


def change_flags(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 attributes: Sequence[str]) -> DataFrame:
    """For each key present on both sides: changed by the NULL-safe and by the plain comparison."""
    pairs = [(F.col(f"t.{a}"), F.col(f"s.{a}")) for a in attributes]
    return (target.alias("t").join(source.alias("s"), list(keys))
            .select(*keys,
                    any_differs(pairs).alias("changed"),
                    any_differs(pairs, null_safe=False).alias("changed_plain")))


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action; ``insert`` + ``update`` is the affected-row count."""
    return merged.groupBy("action").agg(F.count("*").alias("rows"))
