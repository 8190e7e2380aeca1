"""Near-duplicate documents by SetSketch registers.

Every document's set of word shingles becomes ``REGISTERS`` registers: logarithms, to a base little above
1 and cut to a byte, of the smallest of exponential values that its shingles get. The registers of a union
are the larger of both, and equal registers are the likelier the more alike the sets are. Equal runs of
registers (bands) propose pairs; a pair's registers give the likeliest similarity; pairs that may reach
the threshold are compared on their full sets.

Members of a band are compared with one of them, not with each other. Where that leaves a band in several
components, its documents are compared again by an exact method: by prefix filtering, two sets of the
wanted similarity share one of their rarest shingles. Groups of documents that share a rare shingle are
compared with one, then four, then sixteen of their members and so on, until all members have had their turn
or are in one component. Those with the fewest rarer shingles come first, as they have most in common with
the others; a shared shingle with too many rarer ones on either side cannot link a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.components import connected_components
from starmill.llm.tables import documents, released, slices
from starmill.sources.shared import Scratch

WORDS_PER_SHINGLE = 5
# A link needs PERCENT * union <= 100 * intersection.
PERCENT = 85
ROWS, BANDS = 6, 36
REGISTERS = ROWS * BANDS
BASE, RATE, TOP = 1.15, 20.0, 254
# Counters of the table of shingle frequencies; too few only make prefixes less rare.
COUNTERS = 1 << 21
COUNTER_SLICE = 1 << 18
REMEMBERED_WORDS = 200_000
# How many times more members of a group are compared with the others in each round.
MORE = 4

_random = np.random.default_rng(20240601)
FACTORS = (_random.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
SHIFTS = _random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: bytes, words: WordHashes, width: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``width`` words, A-Z lower-cased, of a UTF-8 text.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    found = text.lower().split()  # bytes: A-Z, and exactly the blanks of [\x20\x09-\x0D]
    if not found:
        return np.empty(0, dtype=np.uint64)
    if len(words) > REMEMBERED_WORDS:
        words.clear()
    hashes = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    number = max(1, len(hashes) - width + 1)
    total = np.full(number, min(len(hashes), width), dtype=np.uint64)
    for i in range(min(len(hashes), width)):
        total = (total ^ hashes[i:i + number]) * _MIX
        total ^= total >> np.uint64(29)
    return np.unique(total)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set that is not empty, one byte each."""
    short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 2048):  # long texts in parts: the smallest of all is the same
        values = short[at:at + 2048, None] * FACTORS + SHIFTS
        np.minimum(least, values.min(axis=0), out=least)
    smallest = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP + 1).astype(np.uint8)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of sets of known sizes, from how their registers compare."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    steps = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = chance(u - v * steps), chance(v - u * steps)
    fit = (above[:, None] * np.log(more) + below[:, None] * np.log(less)
           + equal[:, None] * np.log(np.maximum(1 - more - less, 1e-12)))
    return steps[np.arange(len(steps)), fit.argmax(axis=1)]


def least_estimate(percent: int = PERCENT) -> float:
    """Six standard errors of the estimate below the threshold."""
    wanted = percent / 100
    return wanted - 6 * (wanted * (1 - wanted) / REGISTERS) ** 0.5


def alike(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many of a set's first shingles, in any order common to all, hold one of every linked set."""
    return n - -(-percent * n // 100) + 1


# --- What tasks do. ---

def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for whole in batches:
        for batch in slices(whole, "text"):
            sizes, keys, sketches = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_buffer().to_pybytes() if text.is_valid else b"", words)
                sizes.append(len(found))
                keys.append(hashlib.sha256(found.tobytes()).digest()[:16])
                sketches.append(registers(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc"), "n": pa.array(sizes, pa.int64()),
                "set_key": pa.array(keys, pa.binary()), "registers": pa.array(sketches, pa.binary())})


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS)
                        for c in ("registers_a", "registers_b"))
                n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                yield batch.select(["a", "b"]).filter(pa.array(estimate(a, b, n_a, n_b) >= least_estimate(percent)))
    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for whole in batches:
            for batch in slices(whole, "text_a"):
                linked, last, known = [], None, np.empty(0, dtype=np.uint64)
                for text_a, text_b in zip(batch.column("text_a"), batch.column("text_b")):
                    a, b = text_a.as_buffer().to_pybytes(), text_b.as_buffer().to_pybytes()
                    if b != last:
                        last, known = b, shingles(b, words)
                    linked.append(alike(shingles(a, words), known, percent))
                yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, counts = WordHashes(), np.zeros(COUNTERS, dtype=np.int64)
    for whole in batches:
        for batch in slices(whole, "text"):
            found = np.concatenate([shingles(t.as_buffer().to_pybytes(), words) for t in batch.column("text")])
            counts += np.bincount((found % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    for at in range(0, COUNTERS, COUNTER_SLICE):
        part = counts[at:at + COUNTER_SLICE]
        if part.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at // COUNTER_SLICE], pa.int32()),
                                              "counts": pa.array([part.tobytes()], pa.binary())})


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(COUNTER_SLICE, dtype=np.int64)
    for counts in table.column("counts"):
        total += np.frombuffer(counts.as_buffer(), np.int64)
    return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _prefixes(frequencies, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, often = WordHashes(), frequencies.value
        for batch in (part for whole in batches for part in slices(whole, "text")):
            nodes, sizes, keys, places = [], [], [], []
            for node, text in zip(batch.column("node"), batch.column("text")):
                found = shingles(text.as_buffer().to_pybytes(), words)
                order = np.lexsort((found, often[(found % np.uint64(COUNTERS)).astype(np.int64)]))
                prefix = found[order[:prefix_length(len(found), percent)]]
                keys.append(prefix.view(np.int64))
                nodes.append(np.full(len(prefix), node.as_py()))
                sizes.append(np.full(len(prefix), len(found)))
                places.append(np.arange(len(prefix)))
            if nodes:
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(np.concatenate(keys)), "node": pa.array(np.concatenate(nodes), batch.schema.field("node").type),
                    "n": pa.array(np.concatenate(sizes), pa.int64()), "rarer": pa.array(np.concatenate(places), pa.int64())})
    return run


# --- The plan. ---

def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a`` < ``b`` of ``node`` and ``leader`` that their sizes allow to be linked, each once."""
    first = F.col("node") < F.col("leader")
    return (rows.where((F.col("node") != F.col("leader"))
                       & (F.least("n", "leader_n") * 100 >= F.greatest("n", "leader_n") * percent))
            .groupBy(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
            .agg(F.max(F.when(first, F.col("n")).otherwise(F.col("leader_n"))).alias("n_a"),
                 F.max(F.when(first, F.col("leader_n")).otherwise(F.col("n"))).alias("n_b")))


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are alike; ``texts`` has ``node`` and ``text``."""
    kind = dict(pairs.dtypes)["a"]
    with_a = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(released(_confirmed(percent)), f"a {kind}, b {kind}").distinct()


def _with_component(members: DataFrame, components: DataFrame) -> DataFrame:
    return members.join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _open_groups(members: DataFrame) -> DataFrame:
    return (members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low <> high").select("key"))


def _reachable(members: DataFrame, percent: int) -> DataFrame:
    """``members`` without those that no other of their group can be linked with through the group's shingle.

    With ``rarer`` shingles before the first one that a pair shares, at most ``n - rarer`` are shared.
    """
    groups = members.groupBy("key").agg(F.min("n").alias("least_n"), F.count("*").alias("size")).where("size > 1")
    partner = F.greatest(F.col("least_n") * 100, F.col("n") * percent)
    return (members.join(groups, "key")
            .where((F.col("n") - F.col("rarer")) * (100 + percent) * 100 >= percent * (F.col("n") * 100 + partner))
            .select(*members.columns))


def _settle(members: DataFrame, links: DataFrame, checked: DataFrame, texts: DataFrame, percent: int,
            scratch: Scratch) -> DataFrame:
    """``links`` with those that connect members of a group beyond what they connect already.

    In each round ``MORE`` times as many members as in the one before are compared with all others of their
    group; they have met everybody then and leave. Groups in one component are done.
    """
    cells = 1
    while True:
        placed = _with_component(members, connected_components(links, scratch))
        placed = scratch.table(placed.join(_open_groups(placed), "key", "left_semi"))
        if placed.isEmpty():
            return links
        cell = F.pmod(F.xxhash64("node", F.lit(cells)), F.lit(cells))
        leaders = (placed.groupBy("key", cell.alias("cell"))
                   .agg(F.min(F.struct("rarer", "node", "n", "component")).alias("at"))
                   .select("key", F.col("at.node").alias("leader"), F.col("at.n").alias("leader_n"),
                           F.col("at.rarer").alias("leader_rarer"), F.col("at.component").alias("leader_component")))
        shared = F.least(F.col("n") - F.col("rarer"), F.col("leader_n") - F.col("leader_rarer"))
        met = placed.join(leaders, "key").where(
            (F.col("component") != F.col("leader_component"))
            & (shared * (100 + percent) >= (F.col("n") + F.col("leader_n")) * percent))
        pairs = scratch.table(_pairs(met, percent).join(checked, ["a", "b"], "left_anti"))
        found = _links(pairs, texts, percent)
        links = scratch.table(links.union(found))
        checked = scratch.table(checked.union(pairs.select("a", "b")))
        members = placed.join(leaders.select("key", F.col("leader").alias("node")), ["key", "node"], "left_anti") \
            .select("key", "node", "n", "rarer")
        cells *= MORE


def near_duplicates(docs: DataFrame, percent: int = PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """Components of documents linked by shingle sets of Jaccard similarity ``percent`` / 100 or more.

    Words are separated by ASCII white space, A-Z lower-cased; a document's set holds its distinct shingles
    of five words, or the whole sequence if there are fewer. Returns a row per row of ``docs``: ``doc_id``,
    ``n_shingles``, ``component_id`` (the smallest ``doc_id`` that links reach) and ``kept`` (whether that
    is the row's own).

    NULL, empty and blank texts have an empty set, are linked with nothing and kept. Equal sets are one node
    of the graph, whatever their number. Rows with a NULL ``doc_id`` are compared like others; a component of
    such rows only has a NULL ``component_id``, and its rows are kept. Rows that share a ``doc_id`` get the
    component of their own text. Other columns are not looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "near-dedup")
    kind = docs.schema["doc_id"].dataType.simpleString()
    raw = docs.select(F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("text"))
    sketches = scratch.table(raw.mapInArrow(released(_sketched), f"doc {kind}, n long, set_key binary, registers binary"))
    filled = sketches.where("n > 0")
    classes = scratch.table(filled.groupBy("set_key").agg(
        F.min("doc").alias("node"), F.first("n").alias("n"), F.first("registers").alias("registers")))
    nodes = classes.where("node IS NOT NULL")
    bands = nodes.select("node", "n", F.explode(F.expr(
        f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(registers, i * {ROWS} + 1, {ROWS})))"
    )).alias("key"))
    leaders = (bands.groupBy("key").agg(F.min(F.struct("node", "n")).alias("at"), F.count("*").alias("members"))
               .where("members > 1").select("key", F.col("at.node").alias("leader"), F.col("at.n").alias("leader_n")))
    members = scratch.table(bands.join(leaders, "key"))
    grouped = members.select("key", "node", "n")
    pairs = scratch.table(_pairs(members, percent))
    sides = [nodes.select(F.col("node").alias(s), F.col("registers").alias(f"registers_{s}")) for s in "ab"]
    likely = scratch.table(pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(released(_likely(percent)), f"a {kind}, b {kind}"))
    links = scratch.table(_links(likely, raw.where("text IS NOT NULL").withColumnRenamed("doc", "node"), percent))

    placed = scratch.table(_with_component(grouped, connected_components(links, scratch)))
    unsettled = placed.join(_open_groups(placed), "key", "left_semi").select("node").distinct()
    texts = scratch.table(raw.where("text IS NOT NULL").withColumnRenamed("doc", "node")
                          .join(unsettled, "node", "left_semi"))
    if not texts.isEmpty():
        frequencies = np.zeros(COUNTERS, dtype=np.int32)
        schema = "slice int, counts binary"
        for row in texts.select("text").mapInArrow(released(_frequencies), schema).groupBy("slice").applyInArrow(
                _summed, schema).toLocalIterator():
            at = row["slice"] * COUNTER_SLICE
            frequencies[at:at + COUNTER_SLICE] = np.minimum(np.frombuffer(row["counts"], np.int64), 2**31 - 1)
        table = spark.sparkContext.broadcast(frequencies)
        prefixes = scratch.table(texts.mapInArrow(
            released(_prefixes(table, percent)), f"key long, node {kind}, n long, rarer long"))
        links = _settle(_reachable(prefixes, percent), links, pairs.select("a", "b"), texts, percent, scratch)

    components = connected_components(links, scratch)
    of_class = _with_component(classes.select("set_key", "node"), components).select("set_key", "component")
    # A set that very many documents have is one large partition here, which the planner splits.
    found = filled.select("doc", "n", "set_key").join(of_class, "set_key").select("doc", "n", "component")
    empty = sketches.where("n = 0").select("doc", "n", F.col("doc").alias("component"))
    return found.union(empty).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("doc").eqNullSafe(F.col("component")).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, without those that a near duplicate with a smaller ``doc_id`` stands for.

    Rows with a NULL ``doc_id`` stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"), percent, scratch)
    gone = found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op9_minhash_near_dedup": op9_minhash_near_dedup}
ORACLE: dict[str, str] = {}
