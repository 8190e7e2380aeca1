"""Warehouses over several loads."""

import os
import random
import shutil
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import Clock
from sources import D1, D2, D3, TABLES, source
from starmill.functions import labels
from starmill.operators.figures import Figures
from starmill.operators.history import point_in_time, scd2_history, scd2_incremental, scd2_keyed
from starmill.plans import marts
from starmill.plans.audit import RunLog, current_state, monitor
from starmill.plans.facts import DuplicateLines, load_fact
from starmill.plans.loads import Warehouse
from starmill.sources.store import BUCKET, Store, bucket_of
from starmill.streaming.merge_stream import merge_batch
from test_history import FEED, at, feed, random_feed
from test_loads import DIMENSIONS, ENTITIES, state_of
from test_store_and_stream import NEWEST, SCHEMA, events, last_seen

DAY = timedelta(days=1)


@pytest.fixture(scope="module")
def with_dimensions(spark, tmp_path_factory):
    """The small source's dimensions, loaded once."""
    folder = str(tmp_path_factory.mktemp("star") / "wh")
    wh = Warehouse(spark, folder, user="tester", clock=Clock())
    wh.load_calendar()
    for entity, name in zip(ENTITIES, DIMENSIONS):
        wh.stage(entity, source(spark))
        wh.load_dimension(name)
    wh.seed_unknown_salesperson()
    return folder


@pytest.fixture
def make(spark, tmp_path, with_dimensions):
    """A warehouse in a folder of the test, empty or with the dimensions loaded."""
    ids = iter(range(10**6))

    def new(loaded=False, **options):
        if loaded:
            shutil.copytree(with_dimensions, str(tmp_path / "wh"))
        return Warehouse(spark, str(tmp_path / "wh"), user="tester", clock=Clock(datetime(2024, 3, 1)),
                         batch_ids=lambda: f"batch-{next(ids)}", **options)
    return new


def extended(spark, **more):
    """The small source with rows added to some tables."""
    return source(spark, **{name: [*TABLES[name][1], *rows] for name, rows in more.items()})


# -- type 2 with keys --------------------------------------------------------------------------

def plain_keyed(batches):
    """Versions by a plain loop: (key, member, state, from), batch by batch."""
    stored, last = {}, 0
    for batch in batches:
        found = []
        for member in sorted({d[0] for d in batch} | {m for m, _ in stored}):
            line = {ts: (seq, True, state) for (m, ts), (_, seq, state) in stored.items() if m == member}
            for m, ts, seq, state in sorted((d for d in batch if d[0] == member), key=lambda d: d[2]):
                if ts not in line or seq >= line[ts][0]:
                    line[ts] = (seq, ts in line and line[ts][1], state)
            before = object()
            for ts in sorted(line):
                seq, was, state = line[ts]
                if was or state != before:
                    found.append((member, ts, seq, state))
                before = state
        for member, ts, seq, state in sorted(found, key=lambda f: f[:2]):
            key = stored.get((member, ts), (None,))[0]
            if key is None:
                key = last = last + 1
            stored[(member, ts)] = (key, seq, state)
    return sorted((key, m, state, ts) for (m, ts), (key, _, state) in stored.items())


@pytest.mark.parametrize("hot_rows, minutes", [(None, 60), (50, 60)])
def test_keyed_versions_match_a_plain_loop(spark, rows, hot_rows, minutes):
    data = random_feed(11, n=500)
    source_ = random.Random(1)
    batches = [[], [], []]
    for d in data:
        batches[source_.randrange(3)].append(d)
    history = None
    for batch in batches:
        history = scd2_keyed(history, feed(spark, batch), ["k"], "ts", ["state"], "version_key", tie=["seq"],
                             hot_rows=hot_rows, slice_minutes=minutes)
    assert rows(history, "version_key", "k", "state", "valid_from") == [
        tuple(v) for v in rows(spark.createDataFrame(plain_keyed(batches), "version_key long, k int, state string,"
                                                     " valid_from timestamp_ntz"))]
    by_member = history.alias("a").join(history.alias("b"), (F.col("a.k") == F.col("b.k"))
                                        & (F.col("b.version") == F.col("a.version") + 1), "left")
    assert by_member.where("NOT (a.valid_to <=> b.valid_from)").count() == 0
    assert history.where("is_current <> (valid_to IS NULL)").count() == 0


def test_a_late_row_splits_a_version_and_keys_stay(spark, rows):
    first = scd2_keyed(None, feed(spark, [(1, at(0), 1, "a"), (1, at(10), 2, "b"), (2, at(0), 3, "x")]), ["k"], "ts",
                       ["state"], "key", tie=["seq"])
    assert rows(first, "key", "k", "state") == [(1, 1, "a"), (2, 1, "b"), (3, 2, "x")]
    # (1, at(5)) states what the next version states: that one stays, for the facts that refer to it
    late = feed(spark, [(1, at(5), 9, "b"), (1, at(20), 10, "b"), (3, at(0), 11, None), (None, at(0), 12, "n")])
    found = scd2_keyed(first, late, ["k"], "ts", ["state"], "key", tie=["seq"])
    assert rows(found, "key", "k", "state", "valid_from", "valid_to", "version") == [
        (1, 1, "a", at(0), at(5), 1), (2, 1, "b", at(10), None, 3), (3, 2, "x", at(0), None, 1),
        (4, None, "n", at(0), None, 1), (5, 1, "b", at(5), at(10), 2), (6, 3, None, at(0), None, 1)]
    # at the instant of a stored version the greater tie gives the state, under the stored key
    corrected = scd2_keyed(found, feed(spark, [(1, at(10), 1, "lost"), (2, at(0), 99, "y")]), ["k"], "ts", ["state"],
                           "key", tie=["seq"])
    assert rows(corrected.where("key in (2, 3)"), "key", "state") == [(2, "b"), (3, "y")]


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_a_lower_tie_does_not_replace_a_stored_row(spark, rows, hot_rows):
    options = dict(keys=["k"], ts="ts", attributes=["state"], tie=["seq"], hot_rows=hot_rows)
    base = scd2_history(feed(spark, [(1, at(0), 5, "a"), (2, at(0), 5, "a")]), keep=["seq"], **options)
    found = scd2_incremental(base, feed(spark, [(1, at(0), 4, "b"), (2, at(0), 6, "b")]), **options)
    assert rows(found, "k", "state", "seq") == [(1, "a", 5), (2, "b", 6)]


@pytest.mark.parametrize("hot_rows", [0, 50])
def test_facts_of_one_instant_are_spread(spark, rows, hot_rows):
    versions = scd2_history(feed(spark, random_feed(4)), ["k"], "ts", ["state"], tie=["seq"])
    facts = spark.createDataFrame([(0, at(1500), i) for i in range(300)] + [(0, None, i) for i in range(60)]
                                  + [(k, at(100 * k), k) for k in range(6)] + [(None, at(5), 7)],
                                  "k int, ts timestamp_ntz, sale int")
    found = point_in_time(facts, versions, ["k"], "ts", ["state", "version"], hot_rows=hot_rows, slice_minutes=30)
    expected = facts.alias("f").join(
        versions.alias("v"), (facts.k == versions.k) & (facts.ts >= versions.valid_from)
        & (versions.valid_to.isNull() | (facts.ts < versions.valid_to)), "left").select("f.*", "v.state", "v.version")
    assert rows(found) == rows(expected)


def test_sales_refer_to_the_version_of_their_day(spark, make, rows):
    wh = make(loaded=True, histories=["dim_salesperson"])
    for people in ([(21, 1, None, None, None, D1)], [(21, 2, None, None, None, D2)]):
        wh.stage("salesperson", source(spark, sales_person=people), lookback=10_000 * DAY)
        wh.load_history("dim_salesperson")
    heads = [(2001, D1, 1, 21, 1), (2002, D2 - DAY, 1, 21, 1), (2003, D2, 1, 21, 1), (2004, D3, 1, None, 1),
             (2005, D1 - DAY, 1, 21, 1)]
    lines = [(o, 101, 1, 1, Decimal("1"), Decimal("0"), Decimal(o)) for o, *_ in heads]
    src = source(spark, sales_order_header=heads, sales_order_detail=lines)
    wh.load_sales(src, full=True, versions=["dim_salesperson"])
    keys = {r.valid_from: r.version_key for r in wh.history("dim_salesperson").where("salesperson_id_source = 21").collect()}
    assert rows(wh.sales().where("sales_order_id > 2000"), "sales_order_id", "salesperson_key") == [
        (2001, keys[D1]), (2002, keys[D1]), (2003, keys[D2]), (2004, -1), (2005, -1)]
    named = marts.sales_by_salesperson({**wh.star(["dim_salesperson"]), "fact_sales": wh.sales().where("sales_order_id > 2000")})
    assert dict((r.salesperson_key, r.sales) for r in named.collect())[-1] == Decimal("4009.00")
    # a late state splits the first version; what is stored keeps its key
    wh.stage("salesperson", source(spark, sales_person=[(21, None, None, None, None, D1 + DAY)]), lookback=10_000 * DAY)
    wh.load_history("dim_salesperson")
    later = {r.valid_from: r.version_key for r in wh.history("dim_salesperson").where("salesperson_id_source = 21").collect()}
    assert {t: later[t] for t in keys} == keys and len(later) == 3


def test_batches_wait_for_a_declared_history(spark, make, rows):
    for histories, kept in ((["dim_territory"], [1, 2]), ([], [2])):
        wh = Warehouse(spark, make().store.root + str(len(kept)), clock=Clock(), histories=histories)
        for when, name in ((D1, "old"), (D2, "new")):
            wh.stage("territory", source(spark, sales_territory=[(1, name, None, None, when)]))
            wh.load_dimension("dim_territory")
        assert wh.store.versions("stg/territory") == kept
        if histories:
            wh.load_history("dim_territory")
            assert rows(wh.history("dim_territory"), "territory_name", "valid_from") == [("new", D2), ("old", D1)]
            assert wh.store.versions("stg/territory") == [2]
        else:
            with pytest.raises(ValueError, match="declared"):
                wh.load_history("dim_territory")


# -- changes of joined tables ------------------------------------------------------------------

def test_changes_of_joined_tables_are_staged(spark, make, rows):
    wh = make()
    wh.stage("customer", source(spark), follow=True)
    assert wh.staged("customer").count() == 3
    wh.stage("customer", source(spark), follow=True)
    assert wh.staged("customer").count() == 0
    moved = extended(spark, email_address=[(13, "x@x.org", D3)])
    wh.stage("customer", moved, follow=True)
    assert rows(wh.staged("customer"), "customer_id", "email", "modified_date") == [(3, "x@x.org", D3)]
    assert wh.log.last_watermark(labels.STG_CUSTOMER) == D2  # the driving table's own
    wh.stage("customer", moved, follow=True)
    assert wh.staged("customer").count() == 0
    # a new customer that is older than the newest e-mail is not passed over
    newer = extended(spark, email_address=[(13, "x@x.org", D3)], customer=[(4, None, 1, D2 + DAY)])
    wh.stage("customer", newer, follow=True)
    assert rows(wh.staged("customer"), "customer_id") == [(4,)]


def test_changes_behind_two_tables(spark, make, rows):
    def dated(tables):
        return {**tables, **{t: tables[t].withColumn("modified_date", F.lit(D1).cast("timestamp_ntz"))
                             for t in ("address", "product_category", "sales_territory")}}
    wh, src = make(), dated(source(spark))
    for entity in ("customer", "product", "salesperson"):
        wh.stage(entity, src, follow=True)
    changed = dict(src)
    for table, condition in (("address", "address_id = 52"), ("product_category", "true"), ("sales_territory", "territory_id = 1")):
        changed[table] = src[table].withColumn("modified_date", F.when(F.expr(condition), F.lit(D3).cast("timestamp_ntz"))
                                               .otherwise(F.col("modified_date")))
    for entity in ("customer", "product", "salesperson"):
        wh.stage(entity, changed, follow=True)
    assert rows(wh.staged("customer"), "customer_id") == [(1,)]
    assert rows(wh.staged("product"), "product_id", "modified_date") == [(101, D3)]
    assert rows(wh.staged("salesperson"), "salesperson_id") == [(21,)]


def test_lookups_are_cut_to_the_batch(spark):
    from starmill.plans.extracts import extract_customer

    later = extract_customer(source(spark), D1)
    text = later._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") >= 4
    assert [r.customer_id for r in later.collect()] == [3]


# -- later fact loads --------------------------------------------------------------------------

def order(number, day, product=101, customer=1):
    return (number, day, customer, 21, 1), (number, product, 1, 1, Decimal("1"), Decimal("0"), Decimal("1"))


def test_later_loads_read_the_years_of_their_orders(spark, make, rows, monkeypatch):
    wh = make(loaded=True)
    wh.load_sales(source(spark))
    head, line = order(1004, datetime(2015, 1, 5))
    old_head, old_line = order(1000, datetime(2013, 1, 5))
    src = extended(spark, sales_order_header=[head, old_head], sales_order_detail=[line, old_line])
    plans, write = [], type(wh.store)._save

    def seen(self, df, path, partition_by):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(self, df, path, partition_by)

    monkeypatch.setattr(type(wh.store), "_save", seen)
    stored = wh._stored_sales()
    monkeypatch.setattr(wh, "_stored_sales", lambda: stored)
    from starmill.sources.shared import Scratch
    table = Scratch.sized_table
    monkeypatch.setattr(Scratch, "sized_table", lambda self, df: (plans.append(
        df._jdf.queryExecution().executedPlan().toString()), table(self, df))[1])
    wh.load_sales(src)
    lines = next(p for p in plans if "order_year" in p and "LeftAnti" in p)
    assert "PartitionFilters: [order_year" in lines.replace("isnotnull(order_year", "order_year") or "order_year" in \
        lines[lines.index("PartitionFilters"):lines.index("PartitionFilters") + 200]
    monkeypatch.undo()
    # the order of 2013 came after its time and beyond the lookback: only a full load takes it
    assert rows(wh.sales(), "sales_order_id")[-1] == (1004,) and wh.sales().count() == 5
    wh.load_sales(src, full=True)
    assert rows(wh.sales(), "sales_order_id")[0] == (1000,) and wh.sales().count() == 6
    wh.load_sales(src)
    assert state_of(wh, labels.DW_SALES).rows_affected == 0


def test_lines_within_the_lookback_are_found(spark, make, rows):
    wh = make(loaded=True)
    wh.load_sales(source(spark))
    head, line = order(1004, D3 - 3 * DAY)
    wh.load_sales(extended(spark, sales_order_header=[head], sales_order_detail=[line]))
    assert wh.sales().count() == 5


def test_orders_wait_for_a_member_they_miss(spark, make, rows):
    wh = make(loaded=True)
    wh.load_sales(source(spark))  # product 999 of order 1003 is missing
    head, line = order(1004, D3 + 400 * DAY)
    late = [(999, "Late", None, None, None, None, None, None, None, None, None, D3)]
    src = extended(spark, sales_order_header=[head], sales_order_detail=[line], product=late)
    wh.load_sales(src)  # far beyond the lookback of order 1003 by now
    assert wh.sales().count() == 5
    wh.stage("product", src)
    wh.load_dimension("dim_product")
    wh.load_sales(src)
    assert rows(wh.sales(), "sales_order_id", "product_key")[3:] == [(1003, 2), (1003, 3), (1004, 1)]
    assert wh.store.read("etl/waiting/sales").count() == 0


@pytest.mark.parametrize("way", ["infer", "unknown"])
def test_unknown_products_of_one_order_stay_apart(spark, make, rows, way):
    lines = [(1001, p, 1, 1, Decimal("1"), Decimal("0"), Decimal("1")) for p in (997, 998, 101)]
    src = source(spark, sales_order_detail=lines)
    wh = make(loaded=True)
    wh.load_sales(src, on_missing={"dim_product": way}, duplicates="first", line_order=["order_qty"])
    wh.load_sales(src, full=True, on_missing={"dim_product": way})
    wh.load_sales(src, full=True, on_missing={"dim_product": way})
    assert [k for _, k in rows(wh.sales(), "sales_order_id", "product_key")] == ([1, 3, 4] if way == "infer" else [-1, -1, 1])
    if way == "infer":
        assert rows(wh.dimension("dim_product"), "product_key", "product_id_source", "product_name")[2:] == [
            (3, 997, labels.NO_NAME), (4, 998, labels.NO_NAME)]
        late = [(998, "Late", None, None, None, None, None, None, None, None, None, D3)]
        wh.stage("product", extended(spark, product=late))
        wh.load_dimension("dim_product", null_safe=False)
        assert rows(wh.dimension("dim_product"), "product_key", "product_name", "color")[3:] == [(4, "Late", "N/A")]


def test_a_line_without_a_product_id_is_of_the_unknown_member(spark, make, rows):
    lines = [(1001, None, 1, 1, Decimal("1"), Decimal("0"), Decimal("1")), *TABLES["sales_order_detail"][1][:1]]
    wh = make(loaded=True)
    wh.load_sales(source(spark, sales_order_detail=lines), on_missing={"dim_product": "infer"})
    assert rows(wh.sales(), "product_key") == [(-1,), (1,)]
    wh.load_sales(source(spark, sales_order_detail=lines), full=True, on_missing={"dim_product": "infer"})
    assert wh.sales().count() == 2


def test_an_old_duplicate_does_not_block_later_loads(spark, make):
    twice = [*TABLES["sales_order_detail"][1], TABLES["sales_order_detail"][1][0]]
    wh = make(loaded=True)
    wh.load_sales(source(spark, sales_order_detail=twice), duplicates="keep")
    head, line = order(1004, D3)
    wh.load_sales(extended(spark, sales_order_header=[head], sales_order_detail=[line, twice[0]]), full=True)
    assert wh.sales().where("sales_order_id = 1004").count() == 1
    with pytest.raises(DuplicateLines):
        wh.load_sales(extended(spark, sales_order_header=[order(1005, D3)[0]],
                               sales_order_detail=[order(1005, D3)[1]] * 2), full=True)


# -- parts that are rewritten alone ------------------------------------------------------------

def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names
            if f.startswith("part-")}


def test_untouched_buckets_keep_their_files(spark, make, rows):
    many = [(i, None, 1, D1) for i in range(1, 60)]
    plain, cut = make(), Warehouse(spark, make().store.root + "-cut", user="tester", clock=Clock(), buckets={"dim_customer": 8})
    for wh in (plain, cut):
        wh.stage("customer", source(spark, customer=many))
        wh.load_dimension("dim_customer")
    before = files(f"{cut.store.root}/dw/dim_customer")
    changed = [(5, None, 2, D2), (77, None, 2, D2)]
    for wh in (plain, cut):
        wh.stage("customer", source(spark, customer=[*many, *changed][1:]))
        wh.load_dimension("dim_customer")
    columns = ("customer_key", "customer_id_source", "territory_id_source", "load_user")
    # 5 is in the batch once more with its old time, so only the staged rows count
    assert rows(cut.dimension("dim_customer"), *columns) == rows(plain.dimension("dim_customer"), *columns)
    assert state_of(cut, labels.DW_CUSTOMER).rows_affected == state_of(plain, labels.DW_CUSTOMER).rows_affected == 2
    touched = {r[0] for r in spark.createDataFrame([(5,), (77,)], "id long").select(bucket_of(["id"], 8)).collect()}
    after = files(f"{cut.store.root}/dw/dim_customer")
    kept = {f: t for f, t in before.items() if not any(f"{BUCKET}={b}/" in f for b in touched)}
    assert kept and kept.items() <= after.items()
    assert not {f for f in before if f not in kept} & set(after)


def test_an_interrupted_exchange_is_completed(spark, tmp_path, rows, monkeypatch):
    store = Store(spark, str(tmp_path))
    table = spark.range(20).withColumn(BUCKET, bucket_of(["id"], 4))
    store.replace_buckets("t", table)
    newer = table.where(F.col(BUCKET) == 2).withColumn("id", F.col("id") + 100)
    with monkeypatch.context() as stopped:
        stopped.setattr(Store, "finish_buckets", lambda self, table: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            store.replace_buckets("t", newer)
    expected = rows(table.where(F.col(BUCKET) != 2).unionByName(newer).select("id"))
    assert rows(store.read_buckets("t", spark.range(1).schema), "id") == expected
    assert rows(store.read_buckets("t", spark.range(1).schema, [2]), "id") == rows(newer, "id")


# -- versions claimed by streams ---------------------------------------------------------------

def merge(store, data, batch_id, stream):
    merge_batch(store, "seen", SCHEMA, store.spark.createDataFrame(data, SCHEMA), batch_id, ["user_id"],
                ["event_type"], NEWEST, stream)


class Overtaken(Store):
    """Another stream takes the next version while this one is writing its data."""

    def publish(self, table, df, base, owner):
        if not getattr(self, "done", False):
            self.done = True
            merge(Store(self.spark, self.root), events(40, 2), 0, "other")
        return super().publish(table, df, base, owner)


def test_an_overtaken_batch_is_merged_again(spark, tmp_path, rows):
    store = Overtaken(spark, str(tmp_path))
    merge(store, events(40, 1), 0, "own")
    assert store.versions("seen") == [1, 2] and store.owners("seen") == ["other-0", "own-0"]
    both = {}
    for e in sorted([*events(40, 1), *events(40, 2)], key=lambda e: e[2:]):
        both[e[0]] = e
    columns = ("user_id", "event_type", "ts", "event_id")
    assert [r[0] for r in rows(store.read("seen"), *columns)] == sorted(both)
    assert [r[2] for r in rows(store.read("seen"), *columns)] == [both[k][2] for k in sorted(both)]


def test_a_version_is_claimed_once(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    assert store.publish("t", spark.range(1), 0, "a")
    assert not store.publish("t", spark.range(2), 0, "b")
    assert rows(store.read("t")) == [(0,)] and store.owners("t") == ["a"]
    assert not [f for f in os.listdir(tmp_path / "t" / "claims") if "aside" in f]
    for base in (1, 2, 3):
        assert store.publish("t", spark.range(base), base, "a")
    store.prune("t", keep=2)
    assert store.versions("t") == [3, 4]
    assert not store.publish("t", spark.range(9), 0, "late")  # the number is free again, but older than what there is
    assert store.read("t").count() == 3


# -- run log, figures, checks ------------------------------------------------------------------

def test_compacted_log_answers_the_same(spark, make, rows):
    wh = make(loaded=True)
    broken = source(spark)
    broken["product_category"] = broken["product_category"].drop("name")
    with pytest.raises(Exception):
        wh.stage("product", broken)
    wh.log.start(labels.STG_TERRITORY, "open", wh.clock())
    before, shown = rows(current_state(wh.log.read())), rows(monitor(wh.log.read()))
    history = rows(wh.log.history())
    wh.log.compact()
    assert rows(current_state(wh.log.read())) == before and rows(monitor(wh.log.read())) == shown
    assert wh.store.parts(RunLog.TABLE) == [f"{labels.STG_TERRITORY}-open-start"]
    assert rows(wh.log.history()) == history
    assert wh.log.last_watermark(labels.STG_PRODUCT) == D2
    wh.log.compact()  # nothing has ended since
    wh.stage("product", source(spark))
    wh.log.compact()
    assert state_of(wh, labels.STG_PRODUCT).state == "OK" and wh.log.last_watermark(labels.STG_PRODUCT) == D2


def test_log_cut_off_while_compacting(spark, make, rows, monkeypatch):
    wh = make()
    wh.stage("product", source(spark))
    before = rows(current_state(wh.log.read()))
    with monkeypatch.context() as stopped:
        stopped.setattr(Store, "drop_part", lambda *a: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            wh.log.compact()
    assert rows(current_state(wh.log.read())) == before
    history = rows(wh.log.history())
    wh.log.compact()
    assert rows(current_state(wh.log.read())) == before and rows(wh.log.history()) == history
    assert wh.store.parts(RunLog.TABLE) == []


def test_figures_of_a_write(spark, tmp_path):
    written = Figures(spark.range(10).withColumn("x", F.col("id") * 2), count=F.count(F.lit(1)), most=F.max("x"))
    written.rows.write.parquet(str(tmp_path / "a"))
    assert written.count == 10 and written["most"] == 18
    nothing = Figures(spark.range(10).where("id > 20"), count=F.count(F.lit(1)), most=F.max("id"))
    nothing.rows.write.parquet(str(tmp_path / "b"))
    assert nothing.count == 0 and nothing["most"] is None


def test_parts_of_the_stored_fact_are_checked_once(spark, make, rows, monkeypatch):
    wh = make(loaded=True)
    wh.load_sales(source(spark))
    wh.check_sales()
    assert sum(n for _, n in rows(wh.orphans())) == 0 and wh.duplicates().count() == 0
    again = [r.asDict() for r in wh._stored_sales().where("sales_order_id = 1001").collect()]
    more = spark.createDataFrame([{**again[0], "customer_key": 99}], wh._stored_sales().schema)
    wh.store.append("dw/fact_sales", more, "bad", partition_by=["order_year"])
    seen = []
    append = Store.append
    monkeypatch.setattr(Store, "append", lambda self, table, df, part, **o: (seen.append((table, part)), append(self, table, df, part, **o)))
    wh.check_sales()
    assert seen == [("dq/orphans", "bad"), ("dq/duplicates", "bad")]
    assert dict(rows(wh.orphans()))["dim_customer"] == 1
    assert rows(wh.duplicates()) == [(1001, again[0]["product_key"], 2)]


def test_rows_carry_the_session_user(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.stage("territory", source(spark))
    wh.load_dimension("dim_territory")
    assert {r.load_user for r in wh.dimension("dim_territory").collect()} == {spark.sparkContext.sparkUser()}
