"""Every stage of the pipeline after toxicity against a plain version, on a corpus of planted cases."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from starmill.llm import decontaminate, packing
from starmill.llm.decontaminate import shingle_weights, similarity, words_of
from starmill.llm.pii import pseudonymize
from test_lines_and_packing import plain_line_dedup
from test_near_and_fingerprints import edited, plain_components
from texts import frame, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"
ITEMS = [(1, prose(900, 40)), (2, prose(901, 12)), (3, prose(902, 400)), (4, None), (4, prose(900, 40))]


def corpus():
    """Clean texts, shared lines, exact and near copies, and texts that hold benchmark items."""
    shared = [prose(50 + i, 12) for i in range(3)]
    texts = [prose(100 + d, 60) for d in range(25)]
    texts += ["\n".join([prose(200 + d, 30), *shared[:1 + d % 3], prose(300 + d, 30)]) for d in range(12)]
    texts += [prose(7, 150)] * 4 + [edited(prose(7, 150), s, 2) for s in range(6)]
    texts += [f"{prose(400 + d, 20)} {ITEMS[d % 3][1]} {prose(500 + d, 20)}" for d in range(6)]
    texts += ["", None, "one", " \n \n"]
    order = list(range(len(texts)))
    random.Random(3).shuffle(order)
    return [(d, texts[i], "en", "web", len(texts[i] or "")) for d, i in enumerate(order)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("stages")
    frame(spark, ITEMS, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    frame(spark, corpus(), COLUMNS).write.parquet(str(path / "documents.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


STAGES = dict(corpus_pipeline.STAGES)


def result(spark, documents, folder, name):
    found = STAGES[name](spark, documents, folder)
    assert found.columns == documents.columns and found.dtypes == documents.dtypes
    return {r["doc_id"]: r for r in found.collect()}


def test_line_stage(spark, documents, folder):
    found = result(spark, documents, folder, "line dedup")
    expected = {d: text for d, text, _, _ in plain_line_dedup([(d, t or "") for d, t, *_ in corpus()], 5, 40)}
    assert {d: r["text"] or "" for d, r in found.items()} == expected
    assert any(text != (dict((d, t) for d, t, *_ in corpus())[d] or "") for d, text in expected.items())
    assert all(r["n_chars"] == len(r["text"]) for r in found.values() if r["text"] is not None)


def test_near_stage(spark, documents, folder):
    kept = {row[0] for row in plain_components([(d, t) for d, t, *_ in corpus()], corpus_pipeline.SIMILAR_PERCENT) if row[3]}
    assert set(result(spark, documents, folder, "near dedup")) == kept
    assert len(kept) < len(corpus())


def test_decontamination_stage(spark, documents, folder):
    dirty = set()
    for d, text, *_ in corpus():
        words = words_of(text or "")
        for _, item in ITEMS:
            wanted = words_of(item or "")
            weights = shingle_weights(wanted)
            if wanted and any(similarity(weights, shingle_weights(words[at:at + len(wanted)])) >= decontaminate.SIMILARITY
                              for at in range(len(words) - len(wanted) + 1)):
                dirty.add(d)
    assert len(dirty) == 6
    assert set(result(spark, documents, folder, "decontamination")) == {d for d, *_ in corpus()} - dirty


def test_packing_stage(spark, documents, folder):
    pieces = STAGES["packing"](spark, documents, folder).collect()
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    length = {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for d, t, *_ in corpus()}
    assert {p["doc_id"]: p["length"] for p in pieces} == length and len(pieces) == len(length)
    places = Counter()
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == places[p["sequence_id"]]
        places[p["sequence_id"]] += p["length"]
    assert len(places) == -(-sum(length.values()) // packing.CAPACITY)


def test_stages_on_rows_without_text_or_id_and_on_no_rows(spark, documents, folder):
    odd = frame(spark, [(None, None, None, None, None), (None, prose(1, 60), "en", None, 5), (None, prose(1, 60), "en", None, 5),
                        (3, "", None, "x", 0), (3, prose(2, 50), "en", "x", 9)], COLUMNS)
    for name in ("line dedup", "near dedup", "decontamination"):
        kept = Counter((r["doc_id"], r["text"] or "") for r in STAGES[name](spark, odd, folder).collect())
        assert kept == Counter((r["doc_id"], r["text"] or "") for r in odd.collect()), name
        assert STAGES[name](spark, odd.where("doc_id = 99"), folder).collect() == []
    assert len(STAGES["packing"](spark, odd, folder).collect()) == 5
    assert STAGES["packing"](spark, odd.where("doc_id = 99"), folder).collect() == []


def test_ids_of_random_strings_equal_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, source = Tokenizer.from_file(packing.tokenizer_path()), random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZ0123456789'.,-_!?#@&$%()[]{}:;\"/\\ \n\t<|>éüßÖſĸŉǆ"
    texts = ["".join(source.choice(letters) for _ in range(source.randrange(1, 60))) for _ in range(4000)]
    texts += ["".join(source.choice("etaoinshrdlué") for _ in range(source.randrange(1, 40))) for _ in range(4000)]
    words = packing.WordIds(packing.tokenizer_path())
    for text, ids in zip(texts, words.of(texts)):
        assert ids == np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text


def test_long_items_are_found_by_all_of_their_words(spark):
    """Edits in the first words of a long item do not hide it: the whole item has the fingerprint."""
    item, source = prose(77, 1000, vocabulary=5000).split(), random.Random(6)
    docs = []
    for d in range(30):
        words = list(item)
        for at in source.sample(range(256), 6):
            words[at] = f"new{d}x{at}"
        docs.append((d, " ".join([prose(d, 13), *words, prose(d + 50, 21)])))
    found = decontaminate.find_passages(frame(spark, docs), frame(spark, [(1, " ".join(item))], "item_id long, text string"))
    assert {r["doc_id"] for r in found.collect()} == set(range(30))


@pytest.mark.parametrize("value", ["+33 12 34 56 78 90", "41 11 11 11 11 11 11 11", "deadbeef" * 4])
def test_a_value_alone_in_a_text_is_replaced_like_any_other(spark, value):
    alone, among = (r["text"] for r in pseudonymize(frame(spark, [(1, value), (2, f"{value} and 999")]), "k")
                    .orderBy("doc_id").collect())
    assert alone != value and among == f"{alone} and 999"
