import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from starmill.llm.fingerprint import SCALE, fingerprints_beside_next
from starmill.llm.near_dedup import estimate, near_duplicates, one_of_each, registers
from texts import awkward, empty, frame, prose


def word_shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_components(rows, percent):
    sets = {d: word_shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((d, len(sets[d]), root(d), root(d) == d) for d in ids)


def edited(text, seed, times):
    source, words = random.Random(seed), text.split()
    for k in range(times):
        words[source.randrange(len(words))] = f"new{seed}_{k}"
    return " ".join(words)


def copies():
    """A crowd of copies with none to four edits, chains, cut copies, exact copies and texts of their own."""
    base, other = prose(1, 133), prose(2, 90)
    rows = [edited(base, i, i % 5) for i in range(90)]
    rows += [" ".join(other.split()[k:] + prose(50, 90).split()[:k]) for k in range(0, 60, 3)]
    rows += [prose(3, n) for n in range(40, 80, 2)] + ["one two", "one two", "one two three", "", None]
    rows += [prose(100 + i, 70) for i in range(40)] + [base] * 6
    order = list(range(len(rows)))
    random.Random(5).shuffle(order)
    return [(d * 3 - 40, rows[i]) for d, i in enumerate(order)]


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(spark, rows, percent):
    table = copies()
    assert rows(near_duplicates(frame(spark, table), percent)) == plain_components(table, percent)


def test_awkward_rows_of_near_duplicates(spark):
    docs = awkward(spark)
    found = Counter(tuple(r) for r in near_duplicates(docs).collect())
    n = len(word_shingles(prose(1, 60)))
    assert found[6, n, 6, True] == 2 and found[None, n, 6, False] == 1 and found[None, 0, None, True] == 1
    assert found[1, 0, 1, True] == found[2, 0, 2, True] == found[3, 0, 3, True] == found[5, 1, 5, True] == 1
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert near_duplicates(empty(spark)).collect() == [] and one_of_each(empty(spark)).collect() == []


def test_registers_merge_and_estimate():
    source = np.random.default_rng(1)
    whole = source.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = whole[:2000], whole[500:]
    assert (np.maximum(registers(a), registers(b)) == registers(whole)).all()
    found = estimate(registers(a)[None], registers(b)[None], np.array([2000.0]), np.array([2500.0]))
    assert abs(found[0] - 0.5) < 0.15


def test_fingerprints_of_edited_texts(spark):
    table = [(d * 7 - 300, prose(d, 10 + d * 5)) for d in range(90)] + [(1000, None), (1001, "é"), (1002, prose(4, 30))]
    found = {r["doc_id"]: r for r in fingerprints_beside_next(frame(spark, table), scale=1).collect()}
    texts = {d: t or "" for d, t in table}
    ids = sorted(texts)
    for d, after in zip(ids, ids[1:] + ids[:1]):
        text, next_text = texts[d], texts[after]
        cut = len(text) // 4
        new = text[:len(text) - cut] + next_text[:cut]
        row = found[d]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        for name, other in [("near_edited", new), ("near_next", next_text)]:
            a, b = word_shingles(text), word_shingles(other)
            expected = len(a & b) / len(a | b) if a | b else float(text == other)
            assert row[name] == pytest.approx(expected)
    assert len(found) == len(table)


def test_likeness_at_the_fraction_in_use(spark):
    table = [(d, prose(d % 30, 12 + d * 6)) for d in range(120)]
    texts, errors = dict(table), []
    for row in fingerprints_beside_next(frame(spark, table)).collect():
        text, after = texts[row["doc_id"]], texts[(row["doc_id"] + 1) % 120]
        cut = len(text) // 4
        for name, other in (("near_edited", text[:len(text) - cut] + after[:cut]), ("near_next", after)):
            a, b = word_shingles(text), word_shingles(other)
            exact, error = len(a & b) / len(a | b), (SCALE / len(a | b)) ** 0.5 / 2
            errors.append(abs(row[name] - exact))
            assert errors[-1] <= 4.5 * error, (row["doc_id"], name)
    assert sum(errors) / len(errors) < 0.03


def test_equal_texts_have_equal_fingerprints_and_awkward_rows_none_missing(spark):
    docs = awkward(spark)
    found = fingerprints_beside_next(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    assert len({r["fingerprint"] for r in found if r["doc_id"] == 6}) == 1
    assert all(r["near_next"] is None for r in found if r["doc_id"] is None)
    assert fingerprints_beside_next(empty(spark)).collect() == []


def test_components_of_both_ways_are_the_same(spark, monkeypatch):
    from starmill.llm import components
    from starmill.sources.shared import Scratch

    source = random.Random(8)
    links = [(source.randrange(300), source.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    table = spark.createDataFrame(links, "a long, b long").repartition(4)
    with Scratch(spark, "components") as scratch:
        found = sorted(map(tuple, components.connected_components(table, scratch).collect()))
        monkeypatch.setattr(components, "LINKS_IN_A_TASK", 0)
        assert sorted(map(tuple, components.connected_components(table, scratch).collect())) == found
        none = components.connected_components(table.where("a = -1"), scratch)
        monkeypatch.undo()
        assert none.collect() == components.connected_components(table.where("a = -1"), scratch).collect() == []
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    nodes = {x for pair in links for x in pair}
    assert found == sorted((x, root(x)) for x in nodes if root(x) != x)
