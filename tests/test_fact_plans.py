"""The fact load moves lines as rarely as it can, with the same rows."""

from sources import source
from starmill.plans.facts import header_keys, lookups_with, new_lines
from starmill.plans.loads import Warehouse
from starmill.sources.store import Store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_lines_are_sorted_after_their_shuffle_only(spark, rows):
    lines = spark.createDataFrame([(1, 7, 2), (1, 7, 1), (1, None, 4), (1, None, 3), (2, 7, 5)],
                                  "sales_order_id long, product_id long, nth long")
    found = new_lines(lines, None, "first", ["nth"])
    assert rows(found) == [(1, 7, 1), (1, None, 3), (2, 7, 5)]
    assert plan(found).rstrip().splitlines()[-2].strip().startswith("+- Exchange hashpartitioning")


def test_customers_are_looked_up_by_order(spark, rows):
    header = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, -1)], "sales_order_id long, customer_id long")
    dims = {"dim_customer": spark.createDataFrame([(5, 10), (-1, -1)], "customer_key long, customer_id_source long")}
    keys = ["sales_order_id", "customer_key"]

    def found(on_missing="drop", **options):
        left = lookups_with({"dim_customer": on_missing})
        df = header_keys(header, dims, left, **options)
        return df, ("dim_customer" in left)

    df, left = found()
    assert not left and rows(df, *keys) == [(1, 5), (4, -1)]
    assert rows(found(drop=False)[0], *keys) == [(1, 5), (2, None), (3, None), (4, -1)]
    assert rows(found("unknown", drop=False)[0], *keys) == [(1, 5), (2, -1), (3, -1), (4, -1)]
    for df, left in (found("infer"), found(versions=["dim_customer"])):
        assert left and "customer_key" not in df.columns


def test_lines_are_not_shuffled_again_for_their_files(spark, monkeypatch, tmp_path):
    """Between the lookups and the files of the fact there is no shuffle by year."""
    plans, append = [], Store.append

    def seen(store, table, df, *args, **options):
        if table == "dw/fact_sales":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        append(store, table, df, *args, **options)

    monkeypatch.setattr(Store, "append", seen)
    warehouse = Warehouse(spark, str(tmp_path), user="test")
    warehouse.load_calendar()
    warehouse.load_sales(source(spark), duplicates="keep")
    assert len(plans) == 1 and "Rebalance" not in plans[0]
