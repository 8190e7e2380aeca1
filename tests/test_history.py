import random
from datetime import datetime, timedelta

import pytest

from starmill.operators.history import point_in_time, scd2_history, scd2_incremental

T = datetime(2024, 1, 1)
FEED = "k int, ts timestamp_ntz, seq int, state string"


def at(minutes):
    return T + timedelta(minutes=minutes)


def feed(spark, data):
    return spark.createDataFrame(data, FEED)


def random_feed(seed, n=600, keys=5):
    """Key 0 holds a third of the rows; some rows share an instant, some states are NULL."""
    r = random.Random(seed)
    return [(0 if r.random() < 1 / 3 else r.randrange(1, keys), at(r.randrange(3000)), i,
             r.choice(["a", "b", "c", None])) for i in range(n)]


def brute_force(data):
    """Versions by a plain loop."""
    out = []
    for key in sorted({d[0] for d in data}):
        last_at = {}
        for _, ts, seq, state in sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2])):
            last_at[ts] = state
        starts = []
        for ts, state in sorted(last_at.items(), key=lambda x: x[0]):
            if not starts or starts[-1][1] != state:
                starts.append((ts, state))
        for i, (ts, state) in enumerate(starts):
            end = starts[i + 1][0] if i + 1 < len(starts) else None
            out.append((key, state, ts, end, end is None, i + 1))
    return out


def history_of(spark, data, **options):
    return scd2_history(feed(spark, data), ["k"], "ts", ["state"], tie=["seq"], **options)


@pytest.mark.parametrize("hot_rows, minutes", [(None, 60), (10**6, 60), (150, 60), (20, 7), (0, 1440)])
def test_history_matches_a_plain_loop(spark, rows, hot_rows, minutes):
    data = random_feed(1)
    found = history_of(spark, data, hot_rows=hot_rows, slice_minutes=minutes)
    assert rows(found) == rows(spark.createDataFrame(brute_force(data), found.schema))


def test_runs_of_one_state_form_one_version(spark, rows):
    data = [(1, at(0), 1, "a"), (1, at(1), 2, "a"), (1, at(2), 3, "b"), (1, at(3), 4, "a")]
    assert rows(history_of(spark, data)) == [
        (1, "a", at(0), at(2), False, 1), (1, "a", at(3), None, True, 3), (1, "b", at(2), at(3), False, 2)]


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_incremental_equals_full(spark, rows, hot_rows):
    data = sorted(random_feed(2), key=lambda d: (d[1], d[2]))
    cut = at(1500)
    base = history_of(spark, [d for d in data if d[1] < cut])
    delta = feed(spark, [d for d in data if d[1] >= cut])
    found = scd2_incremental(base, delta, ["k"], "ts", ["state"], tie=["seq"], hot_rows=hot_rows,
                             slice_minutes=60)
    assert rows(found) == rows(history_of(spark, data))


def test_late_change_is_placed_inside_the_history(spark, rows):
    base = history_of(spark, [(1, at(0), 1, "a"), (1, at(10), 2, "b"), (2, at(0), 3, "x")])
    late = feed(spark, [(1, at(5), 4, "c")])
    found = scd2_incremental(base, late, ["k"], "ts", ["state"], tie=["seq"])
    assert rows(found) == [
        (1, "a", at(0), at(5), False, 1), (1, "b", at(10), None, True, 3), (1, "c", at(5), at(10), False, 2),
        (2, "x", at(0), None, True, 1)]


def test_new_key_and_unchanged_state(spark, rows):
    base = history_of(spark, [(1, at(0), 1, "a")])
    found = scd2_incremental(base, feed(spark, [(1, at(5), 2, "a"), (9, at(5), 3, "n")]), ["k"], "ts",
                             ["state"], tie=["seq"])
    assert rows(found) == [(1, "a", at(0), None, True, 1), (9, "n", at(5), None, True, 1)]


def test_versions_do_not_overlap_and_one_is_current(spark):
    versions = history_of(spark, random_feed(3), hot_rows=50)
    joined = versions.alias("a").join(versions.alias("b"), "k").where(
        "a.version < b.version and (a.valid_to is null or a.valid_to > b.valid_from)")
    assert joined.count() == 0
    assert versions.where("is_current").groupBy("k").count().where("count <> 1").count() == 0
    assert versions.where("valid_to <= valid_from").count() == 0


@pytest.mark.parametrize("hot_rows, minutes", [(None, 60), (100, 60), (0, 13)])
def test_point_in_time_matches_a_range_join(spark, rows, hot_rows, minutes):
    versions = history_of(spark, random_feed(4))
    r = random.Random(5)
    facts = spark.createDataFrame(
        [(0 if r.random() < 0.4 else r.randrange(1, 6), at(r.randrange(-50, 3100)), i) for i in range(400)],
        "k int, ts timestamp_ntz, sale int")
    found = point_in_time(facts, versions, ["k"], "ts", ["state", "version"], hot_rows=hot_rows,
                          slice_minutes=minutes)
    expected = facts.alias("f").join(
        versions.alias("v"),
        (facts.k == versions.k) & (facts.ts >= versions.valid_from)
        & (versions.valid_to.isNull() | (facts.ts < versions.valid_to)), "left",
    ).select("f.*", "v.state", "v.version")
    assert rows(found) == rows(expected) and found.count() == 400


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_null_keys(spark, rows, hot_rows):
    """NULL is a key like any other in a feed, and matches nothing as the key of a fact."""
    data = random_feed(6)
    nulled = [(None if d[0] == 0 else d[0], *d[1:]) for d in data]
    found = history_of(spark, nulled, hot_rows=hot_rows)
    expected = [(None if v[0] == 0 else v[0], *v[1:]) for v in brute_force(data)]
    assert rows(found) == rows(spark.createDataFrame(expected, found.schema))
    facts = spark.createDataFrame([(None, at(100), i) for i in range(60)] + [(1, at(2999), 60)],
                                  "k int, ts timestamp_ntz, sale int")
    placed = point_in_time(facts, found, ["k"], "ts", ["version"], hot_rows=hot_rows)
    assert placed.count() == 61 and placed.where("version is not null").count() == 1


def test_a_sale_at_a_change_gets_the_new_version_and_gaps_get_none(spark, rows):
    versions = spark.createDataFrame(
        [(1, "a", at(0), at(10)), (1, "b", at(10), at(20)), (1, "c", at(30), None)],
        "k int, state string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([(1, at(-1)), (1, at(0)), (1, at(10)), (1, at(25)), (1, at(30)), (2, at(0))],
                                  "k int, ts timestamp_ntz")
    for hot_rows in (None, 0):
        found = point_in_time(facts, versions, ["k"], "ts", ["state"], hot_rows=hot_rows, slice_minutes=5)
        assert rows(found) == [(1, at(-1), None), (1, at(0), "a"), (1, at(10), "b"), (1, at(25), None),
                               (1, at(30), "c"), (2, at(0), None)]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_rows_without_time_are_left_out_and_null_keys_have_a_history(spark, rows, hot_rows):
    data = [(None, at(0), 1, "a"), (None, at(1), 2, "b"), (1, None, 3, "x"), (1, None, 4, "y"), (1, at(0), 5, "a")]
    expected = [(1, "a", at(0), None, True, 1), (None, "a", at(0), at(1), False, 1), (None, "b", at(1), None, True, 2)]
    by_key = lambda found: sorted(found, key=lambda r: (r[0] is None, r[2]))
    assert by_key(rows(history_of(spark, data, hot_rows=hot_rows))) == expected
    base = history_of(spark, data[:1], hot_rows=hot_rows)
    found = scd2_incremental(base, feed(spark, data[1:]), ["k"], "ts", ["state"], tie=["seq"], hot_rows=hot_rows)
    assert by_key(rows(found)) == expected


def test_tie_may_be_an_attribute(spark, rows):
    data = [(1, at(0), 2, "a"), (1, at(0), 9, "b"), (1, at(0), 5, "c")]
    found = scd2_history(feed(spark, data), ["k"], "ts", ["state", "seq"], tie=["seq"])
    assert rows(found, "state", "seq") == [("b", 9)]
