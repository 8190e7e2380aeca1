"""Aligning the tokens of two tokenizers on the same bytes, and how often their ids meet in a corpus.

The token ends of both tokenizers are two ascending lists of byte offsets. Merging them is cut into pieces
of equal work by merge paths: the point where a diagonal of the merge grid meets the path is found by binary
search, so each piece knows its own stretch of both lists and needs no other. A piece numbers the groups of
its tokens from 0; adding up the groups that earlier pieces close joins them where a group runs across.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.packing import byte_letters
from starmill.llm.tables import documents, slices
from starmill.sources.shared import Scratch

# Ends of both lists that one piece merges.
PIECE = 1 << 16
# Bytes of text aligned together; groups with more links than this are counted by distinct ids.
TEXT_BYTES, LARGE_GROUP = 2 << 20, 4096
# Id pairs that a task counts before it hands them on, and that it looks up at a time.
COUNTED, PAIRS_AT_A_TIME = 1 << 20, 2_000_000

TOKEN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteTokens:
    """Ids and bytes of a byte-level BPE vocabulary, for texts with a space put in front."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        special = {t["content"] for t in settings.get("added_tokens", [])}
        vocabulary = settings["model"]["vocab"]
        to_byte = {letter: byte for byte, letter in byte_letters().items()}
        spelled = {i: bytes(map(to_byte.__getitem__, word)) for word, i in vocabulary.items() if word not in special}
        self.size = max([*vocabulary.values(), *[t["id"] for t in settings.get("added_tokens", [])]]) + 1
        self.bytes = [spelled.get(i, b"") for i in range(self.size)]
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True
        self._fast = None
        merges = [m if isinstance(m, str) else " ".join(m) for m in settings["model"]["merges"]]
        # Where ids follow the order of the merges, ranks alone say the same.
        if all(vocabulary[m.replace(" ", "", 1)] == 256 + i for i, m in enumerate(merges)):
            import tiktoken

            self._fast = tiktoken.Encoding("ranks", pat_str=TOKEN_PATTERN, special_tokens={},
                                           mergeable_ranks={b: i for i, b in spelled.items()})

    def ids(self, text: str) -> np.ndarray:
        text = " " + text
        found = self._fast.encode_ordinary(text) if self._fast else self._whole.encode(text, add_special_tokens=False).ids
        return np.asarray(found, dtype=np.int64)


class PieceTokens:
    """Ids and bytes of a sentence-piece vocabulary, which puts a space in front by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        self.bytes = [bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()
                      for i, piece in enumerate(map(self._model.id_to_piece, range(self.size)))]

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self._model.encode(text, num_threads=1), dtype=np.int64)


def diagonal(a: np.ndarray, b: np.ndarray, steps: int) -> int:
    """How many of the first ``steps`` elements of the merged lists come from ``a``; at equal values ``a`` leads."""
    low, high = max(0, steps - len(b)), min(steps, len(a))
    while low < high:
        middle = (low + high) // 2
        if a[middle] <= b[steps - 1 - middle]:
            low = middle + 1
        else:
            high = middle
    return low


def merge_piece(a: np.ndarray, b: np.ndarray, last_a: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the groups of the tokens with ends ``a`` and ``b``, from 0, and how many groups end here.

    A group ends with a token of ``b`` whose end is also one of ``a``, or ``last_a``, the end of ``a`` before
    this piece.
    """
    at = np.searchsorted(a, b)
    common = b == last_a
    inside = at < len(a)
    common[inside] |= a[at[inside]] == b[inside]
    ends = b[common]
    return np.searchsorted(ends, a), np.searchsorted(ends, b), len(ends)


def group_numbers(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token, from the ascending ends of both tokenizers, of which the last is the same."""
    cuts = [(diagonal(a, b, steps), steps) for steps in [*range(0, len(a) + len(b), piece), len(a) + len(b)]]
    groups_a, groups_b, closed = np.empty_like(a), np.empty_like(b), 0
    for (i, from_), (j, to) in zip(cuts, cuts[1:]):
        own_a, own_b = slice(i, j), slice(from_ - i, to - j)
        of_a, of_b, ended = merge_piece(a[own_a], b[own_b], a[i - 1] if i else -1)
        groups_a[own_a], groups_b[own_b] = closed + of_a, closed + of_b
        closed += ended
    return groups_a, groups_b


class Aligner:
    """Aligns texts under two vocabularies. An id pair is the number ``a * size of b + b``."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.pairs = a.size * b.size
        self._sizes = [np.asarray([len(x) for x in t.bytes], dtype=np.int64) for t in (a, b)]
        # Ids as they are written: followed by a comma, or by what ends the side of a group.
        self._written = [f"{i}{end}" for t, end in ((a, "|"), (b, ";")) for end in (",", end) for i in range(t.size)]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        nothing = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        if not text:
            return nothing
        wanted = b" " + text.encode()
        found = self.a.ids(text), self.b.ids(text)
        for vocabulary, ids in zip((self.a, self.b), found):
            if b"".join(map(vocabulary.bytes.__getitem__, ids.tolist())) != wanted:
                return nothing
        return found

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """Tokens, groups, links and their distinct id pairs of each text; see the keys below."""
        found = [self.tokens(t) for t in texts]
        n = [np.asarray([len(f[s]) for f in found], dtype=np.int64) for s in (0, 1)]
        ids = [np.concatenate([f[s] for f in found]) for s in (0, 1)] if found else [np.empty(0, dtype=np.int64)] * 2
        groups = group_numbers(*[np.cumsum(size[i]) for size, i in zip(self._sizes, ids)])
        n_groups = int(groups[0][-1]) + 1 if len(ids[0]) else 0
        doc_of_a = np.repeat(np.arange(len(texts)), n[0])
        held = [np.bincount(g, minlength=n_groups) for g in groups]
        begins = [np.concatenate([[0], np.cumsum(h)]) for h in held]
        doc_of_group = doc_of_a[begins[0][:-1]] if n_groups else np.empty(0, dtype=np.int64)
        links = held[0] * held[1]
        first_group = np.searchsorted(doc_of_group, np.arange(len(texts) + 1))
        all_links = np.concatenate([[0], np.cumsum(links)])
        pair_docs, keys, times = self._id_pairs(ids, groups[0], held, begins, links, doc_of_group)
        return {"n": n, "ids": ids, "begins": begins, "first_group": first_group,
                "n_links": np.diff(all_links[first_group]), "written": self._texts(ids, groups, begins, n),
                "keys": keys, "times": times, "first_pair": np.searchsorted(pair_docs, np.arange(len(texts) + 1))}

    def _id_pairs(self, ids, group_of_a, held, begins, links, doc_of_group):
        """Distinct id pairs of each text in order, with the number of links that hold them."""
        small = links <= LARGE_GROUP
        wide = np.where(small, held[1], 0)[group_of_a]
        first = np.repeat(begins[1][group_of_a], wide)
        nth = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        key = np.repeat(ids[0], wide) * self.b.size + ids[1][first + nth]
        found = [(np.repeat(doc_of_group[group_of_a], wide) * self.pairs + key, None)]
        for group in np.flatnonzero(~small):
            sides = [np.unique(i[b[group]:b[group + 1]], return_counts=True) for i, b in zip(ids, begins)]
            key = (sides[0][0][:, None] * self.b.size + sides[1][0]).ravel()
            found.append((doc_of_group[group] * self.pairs + key, np.outer(sides[0][1], sides[1][1]).ravel()))
        distinct, times = np.unique(found[0][0], return_counts=True)
        if len(found) > 1:
            every = np.concatenate([distinct, *[k for k, _ in found[1:]]])
            weight = np.concatenate([times, *[t for _, t in found[1:]]])
            order = np.argsort(every, kind="stable")
            starts = np.flatnonzero(np.diff(every[order], prepend=-1))
            distinct, times = every[order][starts], np.add.reduceat(weight[order], starts)
        return distinct // self.pairs, distinct % self.pairs, times

    def _texts(self, ids, groups, begins, n) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        if not len(ids[0]):
            return [""] * len(n[0])
        written = []
        for side, offset in ((0, 0), (1, 2 * self.a.size)):
            codes = ids[side] + offset
            codes[begins[side][1:] - 1] += (self.a, self.b)[side].size
            written.append(codes)
        order = np.argsort(np.concatenate([2 * groups[0], 2 * groups[1] + 1]), kind="stable")
        parts = list(map(self._written.__getitem__, np.concatenate(written)[order].tolist()))
        ends = np.cumsum(n[0] + n[1]).tolist()
        return ["".join(parts[begin:end])[:-1] for begin, end in zip([0, *ends], ends)]


def key_type(pairs: int):
    return np.uint32 if pairs <= 1 << 32 else np.uint64


# --- What tasks do. ---

def _aligned(byte_path: str, piece_path: str, keep_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteTokens(byte_path), PieceTokens(piece_path))
        kind = key_type(aligner.pairs)
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                made = aligner.align(batch.column("text").to_pylist())
                keys, times = made["keys"].astype(kind), made["times"].astype(np.uint32)
                spans = list(zip(made["first_pair"], made["first_pair"][1:]))
                columns = {
                    "row": batch.column("row"), "doc_id": batch.column("doc_id"),
                    "n_a": pa.array(made["n"][0]), "n_b": pa.array(made["n"][1]),
                    "n_groups": pa.array(np.diff(made["first_group"])), "n_links": pa.array(made["n_links"]),
                    "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in made["written"]]),
                    "keys": pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
                    "times": pa.array([times[a:b].tobytes() for a, b in spans], pa.binary())}
                if keep_groups:
                    sides = [pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(i, pa.int32()))
                             for b, i in zip(made["begins"], made["ids"])]
                    columns["groups"] = pa.ListArray.from_arrays(
                        pa.array(made["first_group"], pa.int32()), pa.StructArray.from_arrays(sides, names=["a", "b"]))
                yield pa.RecordBatch.from_pydict(columns)
    return run


def _counted(kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def summed():
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_pydict({"key": pa.array(keys.astype(np.int64)), "documents": pa.array(counts)})

        for batch in batches:
            for keys in batch.column("keys"):
                waiting.append(np.frombuffer(keys.as_buffer(), dtype=kind))
                held += len(waiting[-1])
                if held >= COUNTED:
                    yield summed()
                    waiting, held = [], 0
        if held:
            yield summed()
    return run


def _looked_up(table, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = table.value
        for batch in batches:
            n_best, count_sum = [], []
            for keys, times in zip(batch.column("keys"), batch.column("times")):
                keys = np.frombuffer(keys.as_buffer(), dtype=kind).astype(np.int64)
                times = np.frombuffer(times.as_buffer(), dtype=np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                here = known[at] == keys
                at, times = at[here], times[here]
                n_best.append(int(times[best[at]].sum()))
                count_sum.append(int((times * counts[at]).sum()))
            kept = batch.drop_columns(["keys", "times"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                                             names=[*kept.schema.names, "n_best", "count_sum"])
    return run


# --- The plan. ---

def align(docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = False,
          scratch: Scratch | None = None) -> DataFrame:
    """How the tokens of each text line up under a byte-level (A) and a sentence-piece (B) vocabulary.

    Byte offsets at which tokens of A and of B both end cut a text, with a space in front, into groups; all
    A-B token pairs of a group are linked. The count of an id pair is the number of rows of ``docs`` that
    hold it linked. Returns a row per row of ``docs``: ``doc_id``, ``n_a`` and ``n_b`` (tokens), ``n_groups``,
    ``n_links``, ``n_best`` (links whose count is the highest of their A id, ties included), ``count_sum``
    (over links), ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``), and with ``keep_groups`` the ``groups``
    themselves, each with its ids ``a`` and ``b``.

    Texts that are NULL or empty, or that either tokenizer does not give back byte by byte, have no tokens:
    numbers are 0, ``groups_sha256`` is empty. Strings of special tokens are plain text. Rows that share a
    ``doc_id`` or have none are documents of their own. Other columns are not looked at. An empty table gives
    an empty result.

    Counts of id pairs are handed to tasks ``PAIRS_AT_A_TIME`` at most; more of them take further passes over
    the documents' id pairs, whose sums are added up.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "alignment")
    kind = docs.schema["doc_id"].dataType.simpleString()
    a_size, b_size = ByteTokens(byte_path).size, PieceTokens(piece_path).size
    numbers_type = key_type(a_size * b_size)
    numbers = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    groups = ", groups array<struct<a: array<int>, b: array<int>>>" if keep_groups else ""
    aligned = scratch.table(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _aligned(byte_path, piece_path, keep_groups),
        f"row long, doc_id {kind}, {numbers}, keys binary, times binary{groups}"))

    counts = scratch.table(aligned.select("keys").mapInArrow(_counted(numbers_type), "key long, documents long")
                           .groupBy("key").agg(F.sum("documents").alias("documents")))
    of_a = F.expr(f"key div {b_size}")
    highest = counts.groupBy(of_a.alias("of_a")).agg(F.max("documents").alias("highest"))
    marked = scratch.table(counts.join(highest, of_a == F.col("of_a")).select(
        "key", "documents", (F.col("documents") == F.col("highest")).alias("best")))
    parts = -(-marked.count() // PAIRS_AT_A_TIME) or 1
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * keep_groups]

    def looked_up(part: int, columns: list[str], schema: str) -> DataFrame:
        known = marked.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).toArrow().sort_by("key")
        if not known.num_rows:  # no text has tokens: one pair that does not occur
            known = pa.table({"key": [-1], "documents": [0], "best": [False]})
        table = spark.sparkContext.broadcast(tuple(
            known.column(c).to_numpy() for c in ("key", "documents", "best")))
        return aligned.select(*columns, "keys", "times").mapInArrow(
            _looked_up(table, numbers_type), f"{schema}, n_best long, count_sum long")

    if parts == 1:
        rest = [c for c in aligned.columns if c not in ("keys", "times")]
        return looked_up(0, rest, f"row long, doc_id {kind}, {numbers}{groups}").select(out)
    sums = None
    for part in range(parts):
        found = scratch.table(looked_up(part, ["row"], "row long"))
        sums = found if sums is None else sums.unionByName(found)
    totals = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("keys", "times").join(totals, "row").select(out)


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir), *paths())


QUERIES = {"op11_token_alignment": op11_token_alignment}
ORACLE: dict[str, str] = {}
