"""Packing documents into sequences by minimum bin slack.

How full a sequence gets depends on lengths alone, and there are at most ``capacity`` different lengths,
so the plan is made from the count of pieces of each length, whatever the number of documents. For one
sequence after the other, a subset-sum program on bitsets finds the fullest combination that holds the
longest length left; it is used as often as the counts allow and removed. Pieces find their place in the
plan by their rank among the pieces of their length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starmill.llm.tables import documents, released, slices, text_of
from starmill.sources.shared import Scratch

CAPACITY = 4096
END_ID = 1
# Words whose ids a task remembers; it starts anew beyond that.
REMEMBERED_WORDS = 400_000
# Bytes of text whose words are encoded together.
WORDS_AT_A_TIME = 4 << 20


# Strings that normal forms leave alone and whose split into words and signs needs no Unicode tables.
_PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it can be printed."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


END_OF_WORD = "</w>"
# Bytes of words that are merged by ranks, and those that can end one: printable ASCII, and small letters of
# U+00C0 to U+024F with a to z.
_ASCII = bytes(range(0x21, 0x7F))
_LATIN, _LATIN_ENDS = bytes([*range(0x61, 0x7B), *range(0xC3, 0xCA), *range(0x80, 0xC0)]), bytes([*range(0x61, 0x7B), *range(0x80, 0xC0)])


class RankedWords:
    """Merges words over a few bytes by the ranks of a word-end vocabulary.

    Symbols that end a word differ from those inside one, so each gets a code of its own: the places of
    ``inside`` and then those of ``ends``.
    """

    def __init__(self, vocabulary: dict[str, int], inside: bytes, ends: bytes):
        import tiktoken

        to_byte = {letter: byte for byte, letter in byte_letters().items()}
        self._inside = bytes.maketrans(inside, bytes(range(len(inside))))
        self._ends = {byte: bytes([len(inside) + i]) for i, byte in enumerate(ends)}  # codes of bytes that end a word
        ranks, written = {}, frozenset(to_byte)
        inner, final = frozenset(inside), frozenset(ends)
        for word, i in vocabulary.items():
            plain = word.removesuffix(END_OF_WORD)
            if not plain or not written.issuperset(plain):
                continue
            spelled = bytes(map(to_byte.__getitem__, plain))
            if word == plain:
                if inner.issuperset(spelled):
                    ranks[spelled.translate(self._inside)] = i
            elif spelled[-1] in final and inner.issuperset(spelled[:-1]):
                ranks[self._coded(spelled)] = i
        self._merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks,
                                        special_tokens={})._encode_single_piece

    def _coded(self, word: bytes) -> bytes:
        return word[:-1].translate(self._inside) + self._ends[word[-1]]

    def ids(self, word: str) -> list[int]:
        return self._merge(self._coded(word.encode()))


def ids_follow_merges(vocabulary: dict[str, int], merges: list) -> bool:
    """Whether ids tell which pair is merged first."""
    ids = [vocabulary[m.replace(" ", "", 1) if isinstance(m, str) else "".join(m)] for m in merges]
    return all(a < b for a, b in zip(ids, ids[1:]))


class _Remembered(dict):
    """Values made on first use."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, key):
        self[key] = found = self._make(key)
        return found


class WordIds:
    """Ids, as little-endian unsigned 32-bit integers, of texts under a word-end BPE tokenizer.

    The tokenizer drops white space and lower-cases, so the ids of a text are those of the strings between
    blanks in a row. Each different string is encoded once a task. Plain strings are split here; their parts are
    merged by the ranks of the vocabulary or, where ids do not follow the merges, go straight to the
    tokenizer's model. All other strings go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        settings |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self._model = Tokenizer.from_str(json.dumps(settings))
        self._letters = byte_letters()
        self._packed = [i.to_bytes(4, "little") for i in range(max(settings["model"]["vocab"].values()) + 1)]
        model = settings["model"]
        self._ascii = self._latin = None
        if ids_follow_merges(model["vocab"], model["merges"]):
            self._ascii = RankedWords(model["vocab"], _ASCII, _ASCII)
            self._latin = RankedWords(model["vocab"], _LATIN, _LATIN_ENDS)
        self._words, self._parts = _Remembered(self._of_word), _Remembered(self._of_part)

    def _of_word(self, word: str) -> bytes:
        low = word.lower()
        if "<|" in word or not _PLAIN.fullmatch(low):
            return np.asarray(self._whole.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if low.isalpha():
            return self._parts[low]
        return b"".join(map(self._parts.__getitem__, _PARTS.findall(low)))

    def _of_part(self, part: str) -> bytes:
        ranked = self._ascii if part.isascii() else self._latin if part.isalpha() else None
        if ranked:
            return b"".join(map(self._packed.__getitem__, ranked.ids(part)))
        written = part if part.isascii() else "".join(self._letters[b] for b in part.encode())
        return np.asarray(self._model.encode(written, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def of(self, texts: list[str]) -> Iterator[bytes]:
        if len(self._words) > REMEMBERED_WORDS:
            self._words.clear()
            self._parts.clear()
        for text in texts:
            # Lower-casing ahead makes fewer different strings; it must not touch what depends on case.
            lowered = text if "<|" in text or "\u03a3" in text else text.lower()
            yield b"".join(map(self._words.__getitem__, lowered.replace("\n", " ").split(" ")))


def _pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        task = TaskContext.get().partitionId()
        used: Counter[int] = Counter()
        for whole in batches:
            for batch in slices(whole, "text", WORDS_AT_A_TIME):
                rows, piece, length, crc, slot, kept = [], [], [], [], [], []
                for row, ids in enumerate(words.of(batch.column("text").to_pylist())):
                    ids += end
                    for at in range(0, len(ids), 4 * capacity):
                        part = ids[at:at + 4 * capacity]
                        n = len(part) // 4
                        rows.append(row)
                        piece.append(at // (4 * capacity))
                        length.append(n)
                        crc.append(zlib.crc32(part))
                        slot.append(used[n])
                        used[n] += 1
                        if keep_ids:
                            kept.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array([capacity * p for p in piece], pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array([task] * len(rows), pa.int32()), "slot": pa.array(slot, pa.int64())}
                if keep_ids:
                    columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)
    return run


def fullest(counts: Sequence[int], lengths: Sequence[int], room: int) -> Counter[int]:
    """Lengths, as often as ``counts`` has them, whose sum comes closest to ``room`` from below.

    ``lengths`` are those with a count, longest first. Bit ``s`` of a bitset tells that sum ``s`` can be
    reached; multiples are entered as powers of two, and the choice is read back from the bitsets.
    """
    reached, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        left, times = min(counts[length], room // length), 1
        while left:
            times = min(times, left)
            steps.append((length, times, reached))
            reached |= (reached << length * times) & mask
            left -= times
            times *= 2
            if reached >> room & 1:
                break
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, Counter()
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            chosen[length] += times
    return chosen


def slack_plan(counts: Sequence[int], capacity: int) -> list[tuple[int, Counter[int]]]:
    """How often to use which combination of lengths; ``counts[n]`` is the number of pieces of length n."""
    left = list(counts)
    lengths = [n for n in range(len(left) - 1, 0, -1) if left[n]]
    plan = []
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        chosen = fullest(left, lengths, capacity - longest)
        left[longest] += 1
        chosen[longest] += 1
        often = min(left[n] // times for n, times in chosen.items())
        for n, times in chosen.items():
            left[n] -= often * times
        plan.append((often, chosen))
        lengths = [n for n in lengths if left[n]]
    return plan


def places(plan: list[tuple[int, Counter[int]]]) -> dict[int, np.ndarray]:
    """Per length the runs of ranks: first rank, first sequence, pieces a sequence, offset of the first."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter[int] = Counter()
    sequence = 0
    for often, chosen in plan:
        offset = 0
        for length, times in sorted(chosen.items(), reverse=True):
            runs.setdefault(length, []).append((ranks[length], sequence, times, offset))
            ranks[length] += often * times
            offset += length * times
        sequence += often
    return {length: np.asarray(found, dtype=np.int64) for length, found in runs.items()}


def _placed(table, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(length), np.empty_like(length)
            order = np.argsort(length, kind="stable")
            values, begins = np.unique(length[order], return_index=True)
            for value, rows in zip(values, np.split(order, begins[1:])):
                found = runs[int(value)]
                at = found[np.searchsorted(found[:, 0], rank[rows], side="right") - 1]
                nth = rank[rows] - at[:, 0]
                sequence[rows] = at[:, 1] + nth // at[:, 2]
                offset[rows] = at[:, 3] + nth % at[:, 2] * value
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_pydict({
                **{n: batch.column(n) for n in names},
                "sequence_id": pa.array(sequence), "offset": pa.array(offset)})
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         keep_ids: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Place all documents in as few sequences of at most ``capacity`` tokens as minimum bin slack finds.

    A document is its ids, without special tokens, and ``end_id``. Only documents longer than ``capacity``
    are cut, into pieces of ``capacity``; the last may be shorter. Returns a row per piece: ``doc_id``,
    ``piece``, ``start`` (ids of the document before it), ``length``, ``ids_crc32`` (of its ids as
    little-endian unsigned 32-bit integers), ``sequence_id`` and ``offset``; with ``keep_ids`` also
    ``ids``, from which ``sequences`` puts together the sequences.

    NULL text is empty, and an empty text is the one id ``end_id``. Every row is packed, also those that
    share a ``doc_id`` or have none. Columns other than ``doc_id`` and ``text`` are not looked at. An
    empty table gives an empty result. The tokenizer must not join ids across blanks. The driver holds
    at most ``capacity`` counts and the plan made from them.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "packing")
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    ids = ", ids array<int>" if keep_ids else ""
    pieces = scratch.table(docs.select("doc_id", text_of().alias("text")).mapInArrow(
        released(_pieces(tokenizer_path, capacity, end_id, keep_ids)), f"{fields}, part int, slot long{ids}"))
    # Rank within a length: the pieces of earlier tasks, which are counted, and the number in the task.
    counts = scratch.table(pieces.groupBy("part", "length").agg(F.count("*").alias("pieces")))
    histogram = [0] * (capacity + 1)
    for row in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect():
        histogram[row["length"]] = row["pieces"]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before"))
    table = spark.sparkContext.broadcast(places(slack_plan(histogram, capacity)))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("slot"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids, "rank"]
    return ranked.select(columns).mapInArrow(released(_placed(table, keep_ids)),
                                             f"{fields}{ids}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from ``pack(..., keep_ids=True)``: ``sequence_id`` and ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path())


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
ORACLE: dict[str, str] = {}
