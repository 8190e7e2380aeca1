from datetime import datetime

import pytest

from starmill.operators.merge import (
    AmbiguousSource, action_counts, ambiguous_keys, change_flags, count_unambiguous,
    scd1_merge)

OLD, NOW = datetime(2024, 1, 1), datetime(2024, 2, 1)
STAMPS = {"loaded_at": NOW, "load_user": "it's me"}
TARGET = "key long, id long, name string, territory long, loaded_at timestamp_ntz, load_user string"
SOURCE = "business_id long, full_name string, territory_id long"
COLUMNS = ({"id": "business_id"}, {"name": "full_name", "territory": "territory_id"})


@pytest.fixture
def target(spark):
    return spark.createDataFrame([
        (1, 10, "same", 1, OLD, "a"), (2, 20, "renamed", 1, OLD, "a"), (3, 30, "gains", None, OLD, "a"),
        (4, 40, "loses", 4, OLD, "a"), (5, 50, "absent", 5, OLD, "a"), (-1, -1, "unknown", None, OLD, "a"),
    ], TARGET)


@pytest.fixture
def source(spark):
    return spark.createDataFrame(
        [(10, "same", 1), (20, "new name", 1), (30, "gains", 3), (40, "loses", None), (60, "added", 6)], SOURCE)


EXPECTED = [
    (-1, "unknown", None, OLD, "a", "keep"), (10, "same", 1, OLD, "a", "keep"),
    (20, "new name", 1, NOW, "it's me", "update"), (30, "gains", 3, NOW, "it's me", "update"),
    (40, "loses", None, NOW, "it's me", "update"), (50, "absent", 5, OLD, "a", "keep"),
    (60, "added", 6, NOW, "it's me", "insert")]


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_merge(target, source, rows, broadcast):
    merge = scd1_merge(target, source, *COLUMNS, stamps=STAMPS, broadcast_source=broadcast)
    columns = ("id", "name", "territory", "loaded_at", "load_user", "action")
    assert rows(merge.table, *columns) == EXPECTED
    assert rows(merge.existing.unionByName(merge.new), *columns) == EXPECTED
    assert rows(merge.new, "key", "id") == [(None, 60)]
    assert merge.table.drop("action").dtypes == target.dtypes


@pytest.mark.parametrize("broadcast", [True, False])
def test_plain_comparison_misses_nulls(target, source, rows, broadcast):
    merge = scd1_merge(target, source, *COLUMNS, stamps=STAMPS, null_safe=False,
                       broadcast_source=broadcast)
    assert rows(merge.table.where("action = 'update'"), "id") == [(20,)]
    assert rows(merge.table.where("id in (30, 40)"), "id", "territory") == [(30, None), (40, 4)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_merging_again_changes_nothing(target, source, rows, broadcast):
    first = scd1_merge(target, source, *COLUMNS, stamps=STAMPS, broadcast_source=broadcast).table
    again = scd1_merge(first.drop("action"), source, *COLUMNS, stamps={"loaded_at": OLD, "load_user": "b"},
                       broadcast_source=broadcast).table
    assert rows(again.drop("action")) == rows(first.drop("action"))
    assert rows(action_counts(again)) == [("keep", 7)]


def test_collation_ignores_case_and_trailing_blanks(spark, rows):
    target = spark.createDataFrame([(1, "Ana "), (2, "Eva"), (3, None)], "id int, name string")
    source = spark.createDataFrame([(1, "ANA"), (2, "Noa"), (3, "x")], "id int, name string")
    for collation, expected in [("UTF8_LCASE_RTRIM", [(1, "keep"), (2, "update"), (3, "update")]),
                                (None, [(1, "update"), (2, "update"), (3, "update")])]:
        merged = scd1_merge(target, source, ["id"], ["name"], stamps={}, collation=collation).table
        assert rows(merged, "id", "action") == expected
        assert merged.drop("action").dtypes == target.dtypes


def test_counts(target, source, rows):
    merge = scd1_merge(target, source, *COLUMNS, stamps=STAMPS)
    assert rows(action_counts(merge.table)) == [("insert", 1), ("keep", 3), ("update", 3)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_newer_by_ignores_older_rows(spark, rows, broadcast):
    target = spark.createDataFrame([(1, "b", 5), (2, "b", 5), (3, "b", None)], "id int, v string, at int")
    source = spark.createDataFrame([(1, "old", 4), (2, "new", 6), (3, "first", 1), (4, "in", 1)],
                                   "id int, v string, at int")
    merge = scd1_merge(target, source, ["id"], ["v"], stamps={}, newer_by="at", broadcast_source=broadcast)
    assert rows(merge.table) == [(1, "b", 5, "keep"), (2, "new", 6, "update"), (3, "first", 1, "update"),
                                 (4, "in", 1, "insert")]


def test_change_flags(target, source, rows):
    renamed = source.toDF("id", "name", "territory")
    assert rows(change_flags(target.select("id", "name", "territory"), renamed, ["id"],
                             ["name", "territory"])) == [
        (10, False, False), (20, True, True), (30, True, False), (40, True, False)]


def test_ambiguous_source_is_refused(spark, rows):
    source = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string").distinct()
    assert rows(ambiguous_keys(source, ["id"])) == [(1, 2)]
    with pytest.raises(AmbiguousSource):
        count_unambiguous(source, ["id"])
    assert count_unambiguous(source.where("id = 2"), ["id"]) == 1
    assert count_unambiguous(source.where("id = 7"), ["id"]) == 0


def test_small_batch_leaves_the_target_unshuffled(spark, target, source):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = scd1_merge(target, source, *COLUMNS, stamps=STAMPS, broadcast_source=True).table
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
