import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from starmill.sources.shared import Scratch, fresh_dir, shared_dir
from starmill.sources.store import Store
from starmill.streaming.merge_stream import merge_batch, start_merge_stream


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def test_newest_version_is_read(spark, store, rows):
    store.write("t", spark.range(3))
    store.write("t", store.read("t").where("id > 0"))  # rewritten while it is being read
    assert store.versions("t") == [1, 2] and rows(store.read("t")) == [(1,), (2,)]
    assert rows(store.read("t", before=2)) == [(0,), (1,), (2,)]


def test_versions_are_ordered_as_numbers(spark, store, rows):
    for version in (9, 10):
        store.write("t", spark.range(version), version=version)
    assert store.versions("t") == [9, 10] and store.read("t").count() == 10


def test_interrupted_write_is_not_read(spark, store, rows):
    store.write("t", spark.range(1))
    store.write("t", spark.range(5))
    os.remove(f"{store.root}/t/v=2/_SUCCESS")
    assert rows(store.read("t")) == [(0,)]
    store.write("t", spark.range(2))
    assert store.versions("t") == [1, 2] and store.read("t").count() == 2


def test_missing_table(spark, store):
    assert not store.exists("t")
    with pytest.raises(FileNotFoundError):
        store.read("t")
    assert store.read("t", spark.range(1).schema).count() == 0


def test_parts_add_up_and_are_replaced(spark, store, rows):
    year = lambda df: df.selectExpr("id", "cast(2000 + id as int) as y")
    store.append("f", year(spark.range(0, 2)), "a", partition_by=["y"])
    store.append("f", year(spark.range(2, 4)), "b", partition_by=["y"])
    store.append("f", year(spark.range(2, 3)), "b", partition_by=["y"])
    assert rows(store.read("f")) == [(0, 2000), (1, 2001), (2, 2002)]
    pruned = store.read("f").where("y = 2001")
    assert rows(pruned) == [(1, 2001)]


def test_prune(spark, store):
    for _ in range(4):
        store.write("t", spark.range(1))
    store.prune("t", keep=2)
    assert store.versions("t") == [3, 4]


def test_scratch_tables_live_in_the_shared_folder_and_go_away(spark, rows):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with Scratch(spark, "x") as scratch:
        assert scratch.root.startswith(shared_dir(spark))
        assert scratch.table(spark.range(3)).count() == 3
    assert not os.path.exists(scratch.root)


SCHEMA = StructType([StructField("user_id", LongType()), StructField("event_type", StringType()),
                     StructField("ts", TimestampNTZType()), StructField("event_id", LongType())])
NEWEST = ["ts", "event_id"]


def events(n, seed):
    r = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [(r.randrange(20), r.choice("abc"), start + timedelta(hours=r.randrange(200)), i) for i in range(n)]


def last_seen(data):
    best = {}
    for e in data:
        if e[0] not in best or (e[2], e[3]) > (best[e[0]][2], best[e[0]][3]):
            best[e[0]] = e
    return sorted(best.values())


def start(spark, store, area):
    query = start_merge_stream(spark, f"{area}/in", SCHEMA, store, "seen", ["user_id"], ["event_type"],
                               NEWEST, f"{area}/checkpoint", files_per_batch=2)
    query.awaitTermination()
    return query


def test_stream_merges_files_in_any_order_once(spark, store, rows):
    area = fresh_dir(spark, "stream")
    data = events(300, 7)
    for i in range(0, 300, 60):
        spark.createDataFrame(data[i:i + 60], SCHEMA).coalesce(1).write.mode("append").parquet(f"{area}/in")
    start(spark, store, area)
    columns = ("user_id", "event_type", "ts", "event_id")
    assert rows(store.read("seen"), *columns) == last_seen(data)
    versions = store.versions("seen")
    assert len(versions) == 3

    start(spark, store, area)  # nothing new: no further version
    assert store.versions("seen") == versions

    more = events(50, 8)
    spark.createDataFrame(more, SCHEMA).coalesce(1).write.mode("append").parquet(f"{area}/in")
    start(spark, store, area)
    merged = {e[0]: e for e in last_seen(data)}
    for e in last_seen(more):
        if e[0] not in merged or e[2] > merged[e[0]][2]:
            merged[e[0]] = e
    assert rows(store.read("seen"), *columns) == sorted(merged.values())


def test_repeated_batch_writes_the_same_version(spark, store, rows):
    first, second = events(40, 1), events(40, 2)
    for batch_id, data in [(0, first), (1, second), (1, second)]:
        merge_batch(store, "seen", SCHEMA, spark.createDataFrame(data, SCHEMA), batch_id, ["user_id"],
                    ["event_type"], NEWEST)
    assert store.versions("seen") == [1, 2]
    once = rows(store.read("seen"))
    merge_batch(store, "seen", SCHEMA, spark.createDataFrame(second, SCHEMA), 2, ["user_id"],
                ["event_type"], NEWEST)
    assert rows(store.read("seen")) == once


def test_columns_may_be_called_like_version_folders(spark, store, rows):
    store.write("t", spark.createDataFrame([(1, 2, 3)], "k int, v int, part int"))
    assert store.read("t").columns == ["k", "v", "part"]


def test_new_stream_goes_on_from_the_table(spark, store, rows):
    for stream, data in [("a", events(40, 1)), ("b", events(40, 2))]:
        merge_batch(store, "seen", SCHEMA, spark.createDataFrame(data, SCHEMA), 0, ["user_id"],
                    ["event_type"], NEWEST, stream)
    assert store.versions("seen") == [1, 2]
    assert {r[0] for r in rows(store.read("seen"))} == {e[0] for s in (1, 2) for e in events(40, s)}
