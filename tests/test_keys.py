import random

import pytest
from pyspark.sql import Window, functions as F

from starmill.operators.keys import assign_keys, max_key, rank_all, with_unknown_member
from starmill.plans.dimensions import UNKNOWN_SALESPERSON
from starmill.schemas import WAREHOUSE


@pytest.mark.parametrize("count", [0, 1, 7, 1000])
def test_keys_equal_row_numbers(spark, count):
    ids = random.Random(count).sample(range(10**9), count)
    df = spark.createDataFrame([(i, f"n{i % 13}") for i in ids], "id long, name string").repartition(5)
    keyed = assign_keys(df, ["name", "id"], "k", start=1000)
    expected = df.withColumn("k", 1000 + F.row_number().over(Window.orderBy("name", "id")))
    assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, expected.collect()))


def test_keys_of_one_hot_value_are_still_dense(spark):
    df = spark.range(5000).select(F.lit("same").alias("name"), "id")
    keys = [r.k for r in assign_keys(df, ["name", "id"], "k").orderBy("id").collect()]
    assert keys == list(range(1, 5001))


def test_descending_order(spark):
    keyed = assign_keys(spark.range(100), [F.col("id").desc()], "k")
    assert keyed.where("id + k <> 100").count() == 0


def test_max_key_ignores_the_unknown_member(spark):
    dim = spark.createDataFrame([(-1,)], "k long")
    assert max_key(dim, "k") == 0
    assert max_key(dim.where("k > 0"), "k") == 0
    assert max_key(dim.union(spark.createDataFrame([(9,)], "k long")), "k") == 9


def test_unknown_member_is_added_once(spark):
    empty = spark.createDataFrame([], WAREHOUSE["dim_salesperson"])
    once = with_unknown_member(empty, UNKNOWN_SALESPERSON)
    twice = with_unknown_member(once, UNKNOWN_SALESPERSON)
    row = twice.collect()
    assert len(row) == 1 and row[0].salesperson_key == -1
    assert row[0].full_name == "VENTA POR INTERNET / SIN VENDEDOR" and row[0].job_title == "N/A"


def test_rank_with_ties(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1), ("e", 9)], "id string, v int")
    assert rows(rank_all(df, "v", "r", ["id"])) == [
        ("a", 5, 3), ("b", 9, 1), ("c", 5, 3), ("d", 1, 5), ("e", 9, 1)]


def test_rank_keeps_null_values(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, None), (4, 7)], "id int, v int")
    assert rows(rank_all(df, "v", "r", ["id"])) == [(1, 5, 2), (2, None, 3), (3, None, 3), (4, 7, 1)]
