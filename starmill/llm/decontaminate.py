"""Passages of benchmark items in documents, by SimHash of windows.

Every window of about an item's size is given a 64-bit SimHash of its words: bit by bit the majority of its
words' hashes. Windows begin at every ``STEP`` words, and an item has a fingerprint for each of its first
``STEP`` places, so that one of them lines up with a window wherever the passage stands. Fingerprints are
looked up by four blocks of 16 bits, each with all its neighbours at distance 1: of two fingerprints at
most ``RADIUS`` = 7 apart, one block differs by 1 at most, so none is missed. Passages whose edits move a
fingerprint further than that at all of its places are not found. What is found is compared
exactly, by the weighted similarity of word shingles of the passage and the item; a shingle weighs as many
letters as it has.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.tables import Carried, documents, released, slices
from starmill.sources.tables import read_table

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
STEP = 4
BLOCKS, BLOCK_BITS = 4, 16
RADIUS = 2 * BLOCKS - 1
# Items that are looked for in one pass over the documents; their tables are broadcast.
ITEMS_AT_A_TIME = 20_000
# How far around the place a fingerprint tells the passage is looked for.
SLACK = 2
TEXT_AT_A_TIME = 2 << 20

LETTERS = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def window_steps(words: int) -> int:
    """Steps in the largest window size that fits an item of so many words at each of ``STEP`` places.

    Sizes are every number of steps up to 8, then about an eighth apart, so a window holds seven words in eight
    of its item at least, however long that is.
    """
    most = (words - STEP + 1) // STEP
    size = unit = 1
    while size + unit <= most:
        size += unit
        unit = max(1, size // 8)
    return size if most >= 1 else 0


def word_signs(words: Sequence[str]) -> np.ndarray:
    """+1 and -1 for the hash bits of each word; a row of zeros first, for padding."""
    hashes = np.asarray([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(len(words), 8), axis=1)
    return np.concatenate([np.zeros((1, 64), np.int8), 2 * bits.astype(np.int8) - 1])


def simhash(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprints from the sums of signs, a row each."""
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


def shingle_weights(words: Sequence[str]) -> dict[tuple[str, ...], int]:
    width = min(len(words), WORDS_PER_SHINGLE)
    return {s: sum(map(len, s)) for s in (tuple(words[i:i + width]) for i in range(len(words) - width + 1))}


def similarity(a: dict, b: dict) -> float:
    """Weighted Jaccard similarity of two sets of shingles."""
    both = sum(weight for shingle, weight in a.items() if shingle in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


class Benchmark:
    """Items by window size, with their fingerprints and block tables."""

    def __init__(self, items: Sequence[tuple[object, str]]):
        self.items = [(name, words) for name, text in items if (words := words_of(text or ""))]
        self.weights = [shingle_weights(words) for _, words in self.items]
        self.short: dict[int, dict[tuple[str, ...], list[int]]] = defaultdict(lambda: defaultdict(list))
        prints: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for number, (_, words) in enumerate(self.items):
            steps = window_steps(len(words))
            if not steps:  # so short that only the same words in a row are similar enough
                self.short[len(words)][tuple(words)].append(number)
                continue
            signs = word_signs(words)[1:].astype(np.int32)
            for place in range(STEP):
                own = int(simhash(signs[place:place + STEP * steps].sum(axis=0, keepdims=True))[0])
                prints[steps].append((own, number, place))
        self.short = {n: dict(found) for n, found in self.short.items()}
        self.sizes = {}
        for steps, found in prints.items():
            values = np.asarray([f[0] for f in found], dtype=np.uint64)
            near = np.zeros((BLOCKS, 1 << BLOCK_BITS), dtype=bool)
            for i, blocks in enumerate(values[:, None].view(np.uint16).reshape(len(values), BLOCKS).T):
                near[i, blocks] = True
                for bit in range(BLOCK_BITS):
                    near[i, blocks ^ np.uint16(1 << bit)] = True
            self.sizes[steps] = (values, np.asarray([f[1:] for f in found]), near)

    def passages(self, texts: Sequence[str]) -> list[tuple[int, int, int, float]]:
        """Text, item, first word and similarity of the best passage for each item in each text."""
        numbers: dict[str, int] = {}
        split, rows, owners = [words_of(t) for t in texts], [], []
        for owner, words in enumerate(split):
            padded = np.zeros(-(-len(words) // STEP) * STEP, dtype=np.int32)
            padded[:len(words)] = [numbers.setdefault(w, len(numbers) + 1) for w in words]
            rows.append(padded)
            owners.append(np.full(len(padded) // STEP, owner, dtype=np.int32))
        best: dict[tuple[int, int], tuple[float, int]] = {}

        def consider(owner: int, number: int, first: int) -> None:
            words, weights = split[owner], self.weights[number]
            length = len(self.items[number][1])
            for begin in range(max(0, first - SLACK), max(0, min(first + SLACK, len(words) - length)) + 1):
                found = similarity(shingle_weights(words[begin:begin + length]), weights)
                if found >= SIMILARITY and (found, -begin) > best.get((owner, number), (0.0, 0)):
                    best[owner, number] = (found, -begin)

        owners = np.concatenate(owners) if owners else np.zeros(0, np.int32)
        if len(owners) and self.sizes:
            group_of = np.cumsum(np.bincount(owners, minlength=len(texts))) - np.bincount(owners, minlength=len(texts))
            signs = word_signs(list(numbers))
            flat = np.concatenate(rows).reshape(-1, STEP)
            groups = signs[flat[:, 0]]
            for i in range(1, STEP):
                groups += signs[flat[:, i]]
            # Sums of windows are differences of running sums; with few bits they are right as long as a
            # window's sum fits, whatever the running sum does.
            kind = next(k for k in (np.int8, np.int16, np.int32) if max(self.sizes) * STEP <= np.iinfo(k).max)
            running = np.zeros((len(groups) + 1, 64), dtype=kind)
            np.cumsum(groups, axis=0, dtype=kind, out=running[1:])
            for steps, (values, origin, near) in self.sizes.items():
                if len(groups) < steps:
                    continue
                inside = np.flatnonzero(owners[:len(owners) - steps + 1] == owners[steps - 1:])
                prints = simhash(running[inside + steps] - running[inside])
                blocks = prints.view(np.uint16).reshape(-1, BLOCKS)
                hit = near[0][blocks[:, 0]]
                for i in range(1, BLOCKS):
                    hit |= near[i][blocks[:, i]]
                places = np.flatnonzero(hit)
                for at in range(0, len(places), 1 << 14):
                    some = places[at:at + (1 << 14)]
                    for which in range(0, len(values), 512):
                        apart = np.bitwise_count(prints[some, None] ^ values[None, which:which + 512])
                        for row, column in zip(*np.nonzero(apart <= RADIUS)):
                            group = inside[some[row]]
                            owner, (number, place) = int(owners[group]), origin[which + column]
                            consider(owner, int(number), int((group - group_of[owner]) * STEP - place))
        for owner, words in enumerate(split):
            for length, found in self.short.items():
                for begin in range(len(words) - length + 1):
                    for number in found.get(tuple(words[begin:begin + length]), ()):
                        consider(owner, number, begin)
        return [(owner, number, -begin, value) for (owner, number), (value, begin) in sorted(best.items())]


def benchmark_blocks(benchmark: DataFrame, at_a_time: int = ITEMS_AT_A_TIME) -> Iterator[Benchmark]:
    """The items in blocks of about ``at_a_time``, each small enough to broadcast."""
    number = max(1, -(-benchmark.count() // at_a_time))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for i in range(number):
        rows = benchmark.where(block == i).select("item_id", "text").collect()
        yield Benchmark(sorted(((r["item_id"], r["text"]) for r in rows), key=str))


def _found(block, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for whole in batches:
            for batch in slices(whole, "text", TEXT_AT_A_TIME):
                found = items.passages([t or "" for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                    "item_id": pa.array([items.items[f[1]][0] for f in found], item_type),
                    "first_word": pa.array([f[2] for f in found], pa.int64()),
                    "similarity": pa.array([f[3] for f in found], pa.float64())})
    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, at_a_time: int = ITEMS_AT_A_TIME) -> DataFrame:
    """Documents that hold a benchmark item: ``doc_id``, ``item_id``, ``first_word``, ``similarity``.

    Words are runs of letters and digits, lower-cased. A row per document and item with a passage of the
    item's length whose weighted similarity on shingles of five words (the whole item, if shorter) is
    ``SIMILARITY`` or more; the most similar passage, of equal ones the first. Items of fewer than seven
    words are found as the same words in a row. NULL and empty texts and items match nothing; repeated
    rows are searched and found each for itself, also without an id. Other columns are not looked at.
    Empty tables give an empty result. One pass over the documents for each ``at_a_time`` items.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType
    parts = [docs.select("doc_id", "text").mapInArrow(
        released(_found(Carried(spark, block), to_arrow_type(kinds[1]))),
        f"doc_id {kinds[0]}, item_id {kinds[1].simpleString()}, first_word long, similarity double")
        for block in benchmark_blocks(benchmark, at_a_time)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found


def _clean(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for whole in batches:
            for batch in slices(whole, "text", TEXT_AT_A_TIME):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[f[0] for f in items.passages([t or "" for t in batch.column("text").to_pylist()])]] = False
                yield batch.filter(pa.array(keep))
    return run


def without_passages(docs: DataFrame, benchmark: DataFrame, at_a_time: int = ITEMS_AT_A_TIME) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item; see ``find_passages``."""
    for block in benchmark_blocks(benchmark, at_a_time):
        docs = docs.mapInArrow(released(_clean(Carried(docs.sparkSession, block))), docs.schema)
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op10_decontamination": op10_decontamination}
ORACLE: dict[str, str] = {}
