import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmill.llm import alignment, exact_search, hard_negatives, vectors
from starmill.llm.alignment import ByteTokens, PieceTokens, align, diagonal, group_numbers
from texts import awkward, empty, frame, prose

# --- Alignment ---


@pytest.fixture(scope="module")
def plain_tokens():
    """Tokens as (id, bytes) by each library's own encoder."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_path, piece_path = alignment.paths()
    whole = Tokenizer.from_file(byte_path)
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    letters = {c: b for b, c in alignment.byte_letters().items()}

    def of(text):
        a = [(i, bytes(letters[c] for c in whole.id_to_token(i)))
             for i in whole.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
             for i in pieces.encode(text) for p in [pieces.id_to_piece(i)]]
        return a, b
    return of


def plain_alignment(rows, tokens):
    groups_of, links_of = [], []
    for _, text in rows:
        groups, a_links = [], Counter()
        if text:
            sides = tokens(text)
            if all(b"".join(t for _, t in side) == b" " + text.encode() for side in sides):
                cursor, at, held = [0, 0], [0, 0], ([], [])
                while cursor[0] < len(sides[0]) or cursor[1] < len(sides[1]):
                    s = 0 if at[0] <= at[1] and cursor[0] < len(sides[0]) else 1
                    held[s].append(sides[s][cursor[s]][0])
                    at[s] += len(sides[s][cursor[s]][1])
                    cursor[s] += 1
                    if at[0] == at[1]:
                        groups.append(held)
                        held = ([], [])
        for a_ids, b_ids in groups:
            a_links.update((a, b) for a in a_ids for b in b_ids)
        groups_of.append(groups)
        links_of.append(a_links)
    count = Counter(pair for links in links_of for pair in links)
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for (doc, _), groups, links in zip(rows, groups_of, links_of):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == highest[p[0]]),
                    sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(written.encode()).hexdigest() if written else ""))
    return sorted(out, key=str)


ODD = [None, "", " ", "one", "</s> <s> <unk> <|endoftext|>", "<0x41>▁x", "a▁b", "naïve 漢字 \U0001f600!! \r\n\t x",
       "ﬁ   é", "0123456789" * 40, "x" * 5000, "漢" * 300, "\0\x01", "  two  spaces  ", "don't I'll 'S"]


def strange(seed, n):
    source = random.Random(seed)
    letters = "aAbB  \n\t.,'0123éß漢▁\U0001f600́<>|/sx"
    return ["".join(source.choice(letters) for _ in range(source.randrange(1, 200))) for _ in range(n)]


def test_alignment_equals_brute_force(spark, plain_tokens, monkeypatch):
    texts = [*ODD, *strange(1, 150), *[prose(s, 80) for s in range(20)], prose(3, 80), prose(3, 80)]
    rows = list(enumerate(texts))
    expected = plain_alignment(rows, plain_tokens)
    docs = frame(spark, rows).repartition(5)
    found = align(docs, *alignment.paths())
    assert sorted(map(tuple, found.collect()), key=str) == expected
    # Counts in several parts, added up.
    monkeypatch.setattr(alignment, "PAIRS_AT_A_TIME", 100)
    assert sorted(map(tuple, align(docs, *alignment.paths()).collect()), key=str) == expected


def test_alignment_of_small_pieces_and_large_groups(plain_tokens, monkeypatch):
    texts = [*ODD, *strange(2, 60), prose(5, 400)]
    aligner = alignment.Aligner(*[t(p) for t, p in zip((ByteTokens, PieceTokens), alignment.paths())])
    whole = aligner.align(texts)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    distinct = aligner.align(texts)
    for name in ("keys", "times", "first_pair", "n_links"):
        assert (whole[name] == distinct[name]).all(), name
    sizes = [np.asarray([len(x) for x in t.bytes]) for t in (aligner.a, aligner.b)]
    ends = [np.cumsum(s[i]) for s, i in zip(sizes, whole["ids"])]
    for piece in (1, 2, 3, 7, 100):
        for one, other in zip(group_numbers(*ends), group_numbers(*ends, piece)):
            assert (one == other).all()


def test_merge_path_diagonals():
    source = random.Random(4)
    for _ in range(200):
        a, b = (np.asarray(sorted(source.sample(range(60), source.randrange(0, 30)))) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for steps in range(len(merged) + 1):
            assert diagonal(a, b, steps) == sum(side == 0 for _, side in merged[:steps])


def test_ids_by_ranks_equal_the_tokenizer(plain_tokens):
    fast = ByteTokens(alignment.paths()[0])
    for text in [t for t in ODD if t] + strange(9, 400):
        assert fast.ids(text).tolist() == [i for i, _ in plain_tokens(text)[0]]


def test_groups_are_given_back(spark, plain_tokens):
    rows = [(1, prose(8, 30)), (2, None), (3, "don't")]
    found = {r["doc_id"]: r for r in align(frame(spark, rows), *alignment.paths(), keep_groups=True).collect()}
    for doc, text in rows:
        written = ";".join(",".join(map(str, g["a"])) + "|" + ",".join(map(str, g["b"])) for g in found[doc]["groups"])
        assert (hashlib.sha256(written.encode()).hexdigest() if text else "") == found[doc]["groups_sha256"]
        if text:
            assert [i for g in found[doc]["groups"] for i in g["a"]] == [i for i, _ in plain_tokens(text)[0]]


def test_alignment_of_awkward_rows(spark, plain_tokens):
    rows = [tuple(r) for r in awkward(spark).select("doc_id", "text").collect()]
    found = align(awkward(spark), *alignment.paths())
    assert sorted(map(tuple, found.collect()), key=str) == plain_alignment(rows, plain_tokens)
    assert align(empty(spark), *alignment.paths()).collect() == []


# --- Vectors ---

VECTORS = "vec_id long, embedding array<float>, label int, score string, row int, v string, rank int"


def vector_rows(seed, n, width=6, steps=4):
    """Few different components, so that many scores tie; copies, repeated ids, and rows that take no part."""
    source = random.Random(seed)
    rows = [(i, [source.randrange(-steps, steps + 1) / 8 for _ in range(width)], source.randrange(3)) for i in range(n)]
    rows += [(i, rows[7][1], rows[7][2]) for i in range(n, n + n // 3)]
    rows += [rows[0], rows[0], (100, [0.5] * width, 1), (None, rows[7][1], 0), (None, [1.0] * width, 2), (-50, [1.0] * width, 2)]
    rows += [(200, None, 1), (300, [math.nan] * width, 1), (400, [None] * width, 1), (500, [math.inf] + [0.0] * (width - 1), 1),
             (600, [1.0] * width, None), (700, [], 1), (800, [0.25, 2.0], 0), (900, [1e6, -1e6] * (width // 2), 1)]
    return rows


def usable(row):
    return row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])


def score(a, b):
    return sum(math.floor(256 * float(np.float32(x))) * math.floor(256 * float(np.float32(y))) for x, y in zip(a, b))


def order(pair):
    """By score, then by id, rows without one last."""
    return -pair[0], pair[1] is None, pair[1] or 0


def plain_top(rows, step, k):
    rows = [r for r in rows if usable(r)]
    out = []
    for i, q in enumerate(rows):
        if q[0] is not None and q[0] % step == 0:
            others = sorted([(score(q[1], c[1]), c[0]) for j, c in enumerate(rows) if j != i], key=order)
            out += [(q[0], n + 1, c, s) for n, (s, c) in enumerate(others[:k])]
    return sorted(out, key=str)


def plain_negatives(rows, step):
    rows = [r for r in rows if usable(r) and r[2] is not None]
    out = []
    for i, q in enumerate(rows):
        if q[0] is None or q[0] % step:
            continue
        scored = [(score(q[1], c[1]), c[0], c[2]) for j, c in enumerate(rows) if j != i]
        for best, positive, _ in sorted([s for s in scored if s[2] == q[2]], key=order)[:5]:
            hard = sorted([s for s in scored if s[2] != q[2] and 30 * best <= 100 * s[0] <= 90 * best], key=order)
            out += [(q[0], positive, n + 1, c, best, s) for n, (s, c, _) in enumerate(hard[:10])]
    return sorted(out, key=str)


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "mine", 1, "mine", 2) for r in rows], VECTORS).repartition(5)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_top_products_equal_brute_force(spark, seed):
    rows = vector_rows(seed, 150)
    found = exact_search.top_products(vector_frame(spark, rows), "vec_id % 10 = 0")
    assert sorted(map(tuple, found.collect()), key=str) == plain_top(rows, 10, 5)


def test_top_products_without_bounds_and_in_small_blocks(spark, monkeypatch):
    """No sample to take first bounds from, a few queries at a time, parts of single dimensions."""
    rows = vector_rows(5, 120)
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 8 * 6 * 7)
    monkeypatch.setattr(exact_search, "sample", lambda found, columns: vectors.sample(found, columns, 1))
    found = exact_search.top_products(vector_frame(spark, rows), "vec_id % 10 = 0", k=7)
    assert sorted(map(tuple, found.collect()), key=str) == plain_top(rows, 10, 7)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 0.0], 1), (50, [0.5, 0.5], 1), (3, [0.5, 0.5], 2)]
    found = exact_search.top_products(vector_frame(spark, rows), "vec_id % 50 = 0")
    assert sorted(map(tuple, found.collect()), key=str) == plain_top(rows, 50, 5)
    alone = hard_negatives.hard_negatives(vector_frame(spark, rows[:1]), "vec_id % 50 = 0")
    assert alone.collect() == []


def test_large_components_are_exact(spark):
    rows = [(i, [1e12 * (i + 1), -1e9 * i, 3.0], i % 2) for i in range(0, 40)]
    found = exact_search.top_products(vector_frame(spark, rows), "vec_id % 10 = 0").collect()
    exact = [(q, n, c, max(-2**63 + 1, min(2**63 - 1, s))) for q, n, c, s in plain_top(rows, 10, 40)]
    expected = []
    for q in (0, 10, 20, 30):
        own = sorted([(s, c) for a, _, c, s in exact if a == q], key=order)[:5]
        expected += [(q, n + 1, c, s) for n, (s, c) in enumerate(own)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hard_negatives_equal_brute_force(spark, seed, monkeypatch):
    rows = vector_rows(seed, 120)
    if seed == 2:  # several small indexes a task, few rows scored at a time, several blocks of anchors
        monkeypatch.setattr(hard_negatives, "INDEX_ROWS", 16)
        monkeypatch.setattr(hard_negatives, "ROWS_AT_A_TIME", 1)
        monkeypatch.setattr(vectors, "BLOCK_BYTES", 8 * 6 * 4)
    found = hard_negatives.hard_negatives(vector_frame(spark, rows), "vec_id % 10 = 0")
    assert sorted(map(tuple, found.collect()), key=str) == plain_negatives(rows, 10)


def test_clustered_vectors_leave_cells_unvisited():
    """With cells that lie apart, a search is certified before all rows were scored."""
    random_ = np.random.default_rng(3)
    centres = random_.integers(-300, 300, (12, 16))
    rows = (centres[random_.integers(0, 12, 3000)] + random_.integers(-5, 6, (3000, 16))).astype(np.int64)
    words = [hard_negatives.codebook(part) for part in (rows[:, :8], rows[:, 8:])]
    codes, distances = zip(*[hard_negatives.nearest(p, w) for p, w in zip((rows[:, :8], rows[:, 8:]), words)])
    index = hard_negatives.Index(rows, np.zeros(3000, dtype=np.int64), np.arange(3000), np.arange(3000), codes, distances,
                                 words, rows[:20])
    for a in range(20):
        best, seen = vectors.Best(1, 5), 0
        for at in index.visit(a, 0, np.inf, lambda: best.score[0, -1]):
            seen += len(at)
            found = vectors.products(index.vectors[at], rows[a:a + 1])[:, 0]
            best.add(np.zeros(len(at), dtype=np.int64), found, index.ids[at], index.rows[at])
        assert seen < 3000
        assert best.score[0].tolist() == sorted((rows @ rows[a]).tolist(), reverse=True)[:5]


def test_cells_come_in_the_order_of_their_bounds():
    first, second = [9.0, 4.0, 4.0, -1.0], [7.0, 6.5, 0.0]
    seen = list(hard_negatives.cells_by_bound(first, second))
    assert len({(i, j) for _, i, j in seen}) == 12
    assert [b for b, _, _ in seen] == sorted((f + s for f in first for s in second), reverse=True)


def test_no_vectors(spark):
    nothing = vector_frame(spark, vector_rows(1, 10)).where("vec_id = 123456")
    assert exact_search.top_products(nothing, "vec_id % 50 = 0").collect() == []
    assert hard_negatives.hard_negatives(nothing, "vec_id % 50 = 0").collect() == []


@pytest.mark.parametrize("name", ["op12_exact_top_k", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    from conftest import TESTDATA
    from starmill import llm

    folder = f"{TESTDATA}/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    expected = connection.sql(llm.ORACLE[name]).to_arrow_table()
    found = llm.QUERIES[name](spark, folder).toArrow()
    assert found.num_rows > 0
    rows = [sorted(zip(*[t.column(c).to_pylist() for c in found.column_names])) for t in (found, expected)]
    assert rows[0] == rows[1]
    assert [str(found.schema.field(c).type) for c in found.column_names] == \
        [str(expected.schema.field(c).type) for c in found.column_names]
