import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from starmill.llm import packing
from starmill.llm.line_dedup import line_dedup, line_keys
from texts import awkward, empty, frame, prose


def plain_line_dedup(rows, min_docs, min_chars):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(d, t.split("\n"), [x.strip(" \t\n\v\f\r").translate(upper) for x in t.split("\n")]) for d, t in rows]
    holders = defaultdict(set)
    for d, _, keys in split:
        for k in keys:
            if len(k) >= min_chars:
                holders[k].add(d)
    gone = {k: max(d) for k, d in holders.items() if len(d) >= min_docs}
    return sorted((d, "\n".join(x for x, k in zip(lines, keys) if gone.get(k, d) == d), len(lines),
                   sum(gone.get(k, d) != d for k in keys)) for d, lines, keys in split)


def test_lines_equal_brute_force(spark, rows):
    shared = [prose(i, 12) for i in range(6)] + ["É" * 39 + "Z", "x" * 39, "y" * 40]
    table = []
    for d in range(80):
        lines = [f"  {s.upper() if d % 3 else s}\t" for i, s in enumerate(shared) if (d * 7 + i) % (i + 2) == 0]
        table.append((d, "\n".join([prose(1000 + d, 15), *lines, *lines[:1], ""])))
    for bits in (1 << 25, 1 << 10):  # a filter that is full only suspects more
        found = line_dedup(frame(spark, table), bits=bits)
        assert rows(found, "doc_id", "text", "n_lines", "n_dropped") == plain_line_dedup(table, 5, 40)


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark)
    found = line_dedup(docs, min_docs=2)
    assert found.columns == [c for c in docs.columns if c != "n_dropped"] + ["n_lines", "n_dropped"]
    kept = Counter((r["doc_id"], r["text"], r["_doc"]) for r in found.collect())
    # The long text of rows 6 is also that of a row without id, which counts as no document.
    assert kept == Counter((r["doc_id"], r["text"], r["_doc"]) for r in docs.collect())
    assert line_dedup(empty(spark)).collect() == []


def test_keys_count_code_points():
    assert [k for _, k in line_keys(("ä" * 40 + "\n" + "ä" * 39 + "\n" + "A" * 40).encode(), 40)] == [
        ("ä" * 40).encode(), b"a" * 40]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_plan_uses_every_piece_once_and_fits(lengths):
    counts = np.bincount(lengths, minlength=65).tolist()
    plan = packing.slack_plan(counts, 64)
    used = Counter()
    for often, chosen in plan:
        assert sum(n * times for n, times in chosen.items()) <= 64
        for n, times in chosen.items():
            used[n] += often * times
    assert used == Counter(lengths)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=12), st.integers(1, 60))
def test_fullest_is_the_best_subset_sum(lengths, room):
    counts = np.bincount(lengths, minlength=31).tolist()
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= room}
    chosen = packing.fullest(counts, sorted({n for n in lengths}, reverse=True), room)
    assert sum(n * t for n, t in chosen.items()) == max(sums)
    assert all(t <= counts[n] for n, t in chosen.items())


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    docs = awkward(spark).unionByName(frame(spark, [
        (100 + i, prose(i, 10 + 37 * i) + " It's <|endoftext|> ΑΣ İ é a\tb don't 12,5") for i in range(40)]),
        allowMissingColumns=True)
    packed = packing.pack(docs, path, capacity=256, keep_ids=True)
    pieces = packed.collect()
    expected = Counter()
    for row in docs.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, packing.END_ID]
        for at in range(0, len(ids), 256):
            part = ids[at:at + 256]
            crc = zlib.crc32(np.asarray(part, dtype="<u4").tobytes())
            expected[row["doc_id"], at // 256, at, len(part), crc] += 1
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == expected
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for p in pieces:
        assert whole[p["sequence_id"]][p["offset"]:p["offset"] + p["length"]] == p["ids"]
    total = sum(p["length"] for p in pieces)
    assert sum(map(len, whole.values())) == total and max(map(len, whole.values())) <= 256
    assert len(whole) <= 1.01 * total / 256 + 1
    assert packing.pack(empty(spark), path).collect() == []
