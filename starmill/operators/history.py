"""Type 2 history and lookups at a point in time.

A version is valid from ``valid_from`` (included) to ``valid_to`` (excluded, NULL while open).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.functions.scalars import minute_index
from starmill.operators.keys import assign_keys, max_key
from starmill.operators.slices import (
    HOT_ROWS, SLICE_MINUTES, across_slices, find_hot_keys, hand_over, split_hot)
from starmill.sources.shared import Scratch


def _observed(feed: DataFrame, group: Sequence[str], ts: str, tie: Sequence[str],
              attributes: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows of each group as states in time order, each with the state before it.

    Of several rows at one instant only the last by ``tie`` is left.
    """
    in_order = Window.partitionBy(*group).orderBy(ts, *tie)
    next_ts = F.lead(ts).over(in_order)
    return (feed.withColumn("_next_ts", next_ts)
            .where(F.col("_next_ts").isNull() | (F.col("_next_ts") != F.col(ts)))
            .withColumn("_state", F.struct(*attributes))
            .withColumn("_before", F.lag("_state").over(Window.partitionBy(*group).orderBy(ts)))
            .drop("_next_ts", *[t for t in tie if t not in attributes and t not in keep]))


def _changes(rows: DataFrame, before: Column, group: Sequence[str], ts: str, always: str | None) -> DataFrame:
    """The rows that start a version, with the start of the next one and their number."""
    by_start = Window.partitionBy(*group).orderBy("valid_from")
    starts = before.isNull() | ~before.eqNullSafe(F.col("_state"))
    if always is not None:
        starts = starts | F.col(always)
    return (rows.where(starts)
            .withColumnRenamed(ts, "valid_from")
            .withColumn("_next", F.lead("valid_from").over(by_start))
            .withColumn("_nth", F.row_number().over(by_start)))


def _versions(changes: DataFrame, keys: Sequence[str], attributes: Sequence[str],
              valid_to: Column, version: Column) -> DataFrame:
    return changes.select(*keys, *attributes, "valid_from", valid_to.alias("valid_to"),
                          valid_to.isNull().alias("is_current"),
                          version.cast("long").alias("version"))


def scd2_history(feed: DataFrame, keys: Sequence[str], ts: str, attributes: Sequence[str],
                 tie: Sequence[str] = (), hot_rows: int | None = HOT_ROWS,
                 slice_minutes: int = SLICE_MINUTES, scratch: Scratch | None = None,
                 keep: Sequence[str] = (), always: str | None = None) -> DataFrame:
    """Versions of each key from a feed of observed states.

    Runs of equal states form one version. Of several rows of a key at the same instant the last
    by ``tie`` counts, so no version is empty. Rows without a time have no place in a history and are
    left out. Rows whose key is NULL have a history of their own. Result: keys, attributes,
    ``valid_from``, ``valid_to``, ``is_current``, ``version``. One shuffle by key covers all windows.

    ``keep`` names columns that go with the version their row starts, such as ``tie``, which a later
    ``scd2_incremental`` needs to decide between rows of one instant. Rows for which the column
    ``always`` is true start a version even where the state is the one before.
    """
    keys, attributes, tie = list(keys), list(attributes), list(tie)
    keep = [c for c in keep if c not in attributes]
    result = [*attributes, *keep]
    scratch = scratch or Scratch(feed.sparkSession, "history")
    columns = dict.fromkeys([*keys, ts, *tie, *result, *([always] if always else [])])
    feed = feed.select(*columns).where(F.col(ts).isNotNull())
    hot = find_hot_keys(feed, keys, hot_rows, scratch)
    ordinary, busy = (feed, None) if hot is None else split_hot(feed, keys, ts, hot, slice_minutes)

    rows = _observed(ordinary, keys, ts, tie, attributes, keep)
    versions = _versions(_changes(rows, F.col("_before"), keys, ts, always), keys, result,
                         F.col("_next"), F.col("_nth"))
    if busy is None:
        return versions

    group = [*keys, "_slice"]
    rows = hand_over(
        scratch.table(_observed(busy, group, ts, tie, attributes, keep)), keys,
        summary={"_last": F.max_by("_state", ts)},
        across={"_carried": F.lag("_last").over(across_slices(keys))})
    changes = scratch.table(_changes(rows, F.coalesce("_before", "_carried"), group, ts, always))
    earlier = across_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    changes = hand_over(
        changes, keys,
        summary={"_first": F.min("valid_from"), "_count": F.count("*")},
        across={"_following": F.lead("_first").over(across_slices(keys)),
                "_earlier": F.sum("_count").over(earlier)})
    return versions.unionByName(_versions(
        changes, keys, result, F.coalesce("_next", "_following"),
        F.col("_nth") + F.coalesce("_earlier", F.lit(0))))


def _with_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on the keys; a NULL key matches a NULL key."""
    per_key = per_key.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return rows.join(per_key, same, "left").drop(*[f"_of_{k}" for k in keys])


def _reopened(history: DataFrame, delta: DataFrame, keys: Sequence[str], ts: str,
              scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Versions that end before their key's earliest new row, and the others of keys that have one."""
    # A small delta is broadcast by the planner, and the history is not shuffled.
    marked = _with_key(history, delta.groupBy(*keys).agg(F.min(ts).alias("_since")), keys)
    untouched = F.col("_since").isNull() | F.coalesce(F.col("valid_to") < F.col("_since"), F.lit(False))
    return marked.where(untouched).select(*history.columns), scratch.table(marked.where(~untouched).drop("_since"))


def _renumbered(rebuilt: DataFrame, reopened: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Version numbers of rebuilt rows go on after those that were kept."""
    base = reopened.groupBy(*keys).agg((F.min("version") - 1).alias("_base"))
    return _with_key(rebuilt, base, keys).withColumn(
        "version", F.col("version") + F.coalesce("_base", F.lit(0))).drop("_base")


def scd2_incremental(history: DataFrame, delta: DataFrame, keys: Sequence[str], ts: str,
                     attributes: Sequence[str], tie: Sequence[str] = (),
                     hot_rows: int | None = HOT_ROWS, slice_minutes: int = SLICE_MINUTES,
                     scratch: Scratch | None = None) -> DataFrame:
    """Apply new observations to a stored history.

    For a key in ``delta`` only the versions that end at or after its earliest new row are
    rebuilt, normally just the open one; everything else passes through. A late row takes effect
    until the next recorded change.

    A history that keeps the ``tie`` columns (``keep`` of ``scd2_history``) decides by them between
    a stored row and a new one of the same instant; without them the new row counts as the later.
    """
    keys, attributes = list(keys), list(attributes)
    keep = [t for t in tie if t not in attributes and t in history.columns]
    scratch = scratch or Scratch(history.sparkSession, "history")
    delta = delta.where(F.col(ts).isNotNull())
    kept, reopened = _reopened(history, delta, keys, ts, scratch)
    known = reopened.select(*keys, F.col("valid_from").alias(ts), *attributes, *keep,
                            *[F.lit(None).cast(delta.schema[t].dataType).alias(t) for t in tie
                              if t not in attributes and t not in keep])
    rebuilt = scd2_history(known.unionByName(delta.select(*known.columns)), keys, ts, attributes,
                           tie, hot_rows, slice_minutes, scratch, keep)
    return kept.unionByName(_renumbered(rebuilt, reopened, keys).select(*history.columns))


def scd2_keyed(history: DataFrame | None, delta: DataFrame, keys: Sequence[str], ts: str,
               attributes: Sequence[str], key: str, tie: Sequence[str] = (),
               hot_rows: int | None = HOT_ROWS, slice_minutes: int = SLICE_MINUTES,
               scratch: Scratch | None = None) -> DataFrame:
    """A type 2 dimension after new observations: versions with a surrogate key of their own.

    Facts refer to versions by ``key``, so a stored version never goes away and keeps its key. A
    late row that differs from the state before it starts a version of its own inside the one it
    falls into, which ends there; it holds until the next stored version, also if that states the
    same. At the instant a stored version starts, the row that is greater by ``tie`` gives the
    state (a new row at equal ties), under the stored key. New versions are numbered after the
    greatest key, by ``keys`` and start. Returns ``key``, keys, attributes, ``tie``, ``valid_from``,
    ``valid_to``, ``is_current``, ``version``. ``history`` is None for the first load.
    """
    keys, attributes = list(keys), list(attributes)
    tie = [t for t in tie if t not in attributes]
    scratch = scratch or Scratch(delta.sparkSession, "versions")
    delta = delta.select(*dict.fromkeys([*keys, ts, *attributes, *tie])).where(F.col(ts).isNotNull()).withColumns(
        {key: F.lit(None).cast("long"), "_stored": F.lit(False)})
    feed, kept, reopened, last = delta, None, None, 0
    if history is not None:
        kept, reopened = _reopened(history, delta, keys, ts, scratch)
        stored = reopened.withColumnRenamed("valid_from", ts).withColumn("_stored", F.lit(True))
        feed, last = feed.unionByName(stored.select(*feed.columns)), max_key(history, key)
    # One row per instant, by an aggregate that combines before the shuffle.
    state = F.max(F.struct(*tie, (~F.col("_stored")).alias("_new"), *attributes))
    instants = feed.groupBy(*keys, ts).agg(state.alias("_at"), F.max(key).alias(key), F.max("_stored").alias("_stored")) \
        .select(*keys, ts, *[F.col(f"_at.{c}").alias(c) for c in [*attributes, *tie]], key, "_stored")
    versions = scd2_history(instants, keys, ts, attributes, (), hot_rows, slice_minutes, scratch,
                            keep=[*tie, key], always="_stored")
    if reopened is not None:
        versions = _renumbered(versions, reopened, keys)
    columns = [key, *keys, *attributes, *tie, "valid_from", "valid_to", "is_current", "version"]
    versions = scratch.table(versions.select(*columns))
    new = assign_keys(versions.where(F.col(key).isNull()).drop(key), [*keys, "valid_from"], key, start=last,
                      scratch=scratch)
    result = versions.where(F.col(key).isNotNull()).unionByName(new)
    return result if kept is None else kept.select(*columns).unionByName(result)


def point_in_time(facts: DataFrame, history: DataFrame, keys: Sequence[str], ts: str,
                  attributes: Sequence[str], hot_rows: int | None = HOT_ROWS,
                  slice_minutes: int = SLICE_MINUTES, scratch: Scratch | None = None) -> DataFrame:
    """``facts`` with the attributes of the version valid at ``ts``; NULL when there was none.

    Both inputs are merged into one time line per key and the last version is carried forward.
    The work grows with facts + versions; a join on the key with a range condition would pair
    every fact of a key with every version of it.

    A key with more than ``hot_rows`` rows is put on the time line as its distinct instants, and
    its facts are joined to these. Facts that share an instant beyond that number are spread by a
    salt, with a copy of the instant for each value of it.
    """
    keys = list(keys)
    scratch = scratch or Scratch(facts.sparkSession, "point-in-time")
    if hot_rows is not None:
        facts = scratch.table(facts)  # read several times; it may be the end of a long plan
    # Facts without a key match nothing, however many there are.
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    unmatched = facts.where(unkeyed).select(
        "*", *[F.lit(None).cast(history.schema[a].dataType).alias(a) for a in attributes])
    facts = facts.where(~unkeyed)
    version = F.struct(*attributes, "valid_to")
    version_type = history.select(version.alias("v")).schema["v"].dataType

    def time_line(history: DataFrame, rows: DataFrame) -> DataFrame:
        """Starts of versions and ``rows`` (keys, ``ts`` and others) of the same keys."""
        payload_type = rows.select(F.struct(*rows.columns).alias("f")).schema["f"].dataType
        starts = history.select(*keys, F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"),
                                version.alias("_version"), F.lit(None).cast(payload_type).alias("_fact"))
        return starts.unionByName(rows.select(
            *keys, F.col(ts).alias("_at"), F.lit(1).alias("_kind"),
            F.lit(None).cast(version_type).alias("_version"), F.struct(*rows.columns).alias("_fact")))

    def carried_within(rows: DataFrame, group: Sequence[str]) -> DataFrame:
        so_far = (Window.partitionBy(*group).orderBy("_at", "_kind")
                  .rowsBetween(Window.unboundedPreceding, 0))
        return rows.withColumn("_valid", F.last("_version", ignorenulls=True).over(so_far))

    def resolve(rows: DataFrame, found: Column) -> DataFrame:
        holds = found["valid_to"].isNull() | (F.col("_at") < found["valid_to"])
        return rows.where(F.col("_kind") == 1).select(
            "_fact.*", *[F.when(holds, found[a]).alias(a) for a in attributes])

    hot = find_hot_keys(history.select(*keys).unionByName(facts.select(*keys)), keys, hot_rows, scratch)
    if hot is None:
        return resolve(carried_within(time_line(history, facts), keys), F.col("_valid")).unionByName(unmatched)

    named = F.broadcast(hot.toDF(*[f"_hot_{k}" for k in keys]))
    is_hot = [F.col(k) == F.col(f"_hot_{k}") for k in keys]
    ordinary = time_line(history.join(named, is_hot, "left_anti"), facts.join(named, is_hot, "left_anti"))
    busy_facts = facts.join(named, is_hot, "left_semi")

    # Instants of the hot keys: the aggregate combines before its shuffle, however many facts share one.
    instants = scratch.table(busy_facts.groupBy(*keys, ts).agg(F.count("*").alias("_rows")))
    line = time_line(history.join(named, is_hot, "left_semi"), instants).withColumn(
        "_slice", minute_index("_at", slice_minutes))
    earlier = across_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = hand_over(
        scratch.table(carried_within(line, [*keys, "_slice"])), keys,
        summary={"_last": F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_at")))},
        across={"_carried": F.last("_last", ignorenulls=True).over(earlier)})
    valid = resolve(placed, F.coalesce("_valid", "_carried"))
    salts = F.ceil(F.col("_rows") / max(hot_rows, 1)).cast("int")
    copies = valid.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_rows").withColumnsRenamed(
        {c: f"_of_{c}" for c in [*keys, ts, "_salt"]})
    # At most (facts / hot_rows) instants can be above hot_rows.
    crowded = F.broadcast(instants.where(F.col("_rows") > max(hot_rows, 1)).select(
        *[F.col(c).alias(f"_in_{c}") for c in [*keys, ts]], salts.alias("_salts")))
    salted = busy_facts.join(crowded, [F.col(c) == F.col(f"_in_{c}") for c in [*keys, ts]], "left").withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("_salts", F.lit(1))).cast("int"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [ts]] + [F.col(c) == F.col(f"_of_{c}") for c in [*keys, "_salt"]]
    busy = salted.join(copies, same).select(*facts.columns, *attributes)
    return (resolve(carried_within(ordinary, keys), F.col("_valid"))
            .unionByName(busy).unionByName(unmatched))
