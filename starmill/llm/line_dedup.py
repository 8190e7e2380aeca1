"""Line deduplication with two Bloom filters.

A first pass sets, for the key of every line, bits in a filter of lines seen once and, for keys met
again, in a filter of lines seen twice. Filters of tasks merge by ``twice = a.twice | b.twice |
(a.once & b.once)``. A second pass sends only lines that the merged filter of twice-seen keys contains
to a shuffle, by digest, where documents are counted exactly and the document that keeps the line is
chosen. The filters have a fixed size: when they fill up, more lines are suspected and shuffled, and the
result stays the same.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.tables import BLANKS, LOWER, UPPER, documents, free_name, text_of
from starmill.sources.shared import Scratch

MIN_CHARS = 40
MIN_DOCS = 5
# Bits of each filter: 4 MB a filter, which is what a task holds and what is broadcast.
FILTER_BITS = 1 << 25
PROBES = 3
# Filters travel in slices, merged by groups of tasks and then once more.
SLICE_BITS = 1 << 19
MERGE_TASKS = 64


def line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """Number and key of every line of a UTF-8 text whose key has at least ``min_chars`` code points."""
    for number, line in enumerate(text.split(b"\n")):
        key = line.strip(BLANKS)
        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            yield number, key.lower()  # of bytes: A-Z only


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of 64-bit hashes, one row a probe."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (hashes + probes * step) % np.uint64(bits)


def filter_bytes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Filter holding ``hashes``, as bytes."""
    flags = np.zeros(bits, dtype=bool)
    flags[positions(hashes, bits).ravel()] = True
    return np.packbits(flags, bitorder="little")


def _task_filters(bits: int, min_chars: int, slice_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update({xxhash.xxh3_64_intdigest(key)
                               for _, key in line_keys(text.as_buffer().to_pybytes(), min_chars)})
        if not counts:
            return
        hashes = np.fromiter(counts.keys(), dtype=np.uint64, count=len(counts))
        often = np.fromiter(counts.values(), dtype=np.int64, count=len(counts)) > 1
        once, twice = filter_bytes(hashes, bits), filter_bytes(hashes[often], bits)
        # Two different keys of one task may share all bits; that only leaves a repeat across tasks
        # to be found by the merge, which sees the same bits once more.
        width = slice_bits // 8
        task = TaskContext.get().partitionId()
        for at in range(0, len(once), width):
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([at // width], pa.int32()), "task": pa.array([task], pa.int32()),
                "once": pa.array([once[at:at + width].tobytes()], pa.binary()),
                "twice": pa.array([twice[at:at + width].tobytes()], pa.binary())})
    return run


FILTER_SCHEMA = "slice int, task int, once binary, twice binary"


def _merge(table: pa.Table) -> pa.Table:
    """One filter slice from those of several tasks."""
    once = twice = None
    for a, b in zip(table.column("once"), table.column("twice")):
        more, again = np.frombuffer(a.as_py(), np.uint8), np.frombuffer(b.as_py(), np.uint8)
        if once is None:
            once, twice = more.copy(), again.copy()
        else:
            twice |= again | (once & more)
            once |= more
    return pa.table({"slice": table.column("slice")[:1], "task": table.column("task")[:1],
                     "once": pa.array([once.tobytes()], pa.binary()),
                     "twice": pa.array([twice.tobytes()], pa.binary())})


def twice_seen(texts: DataFrame, bits: int = FILTER_BITS, min_chars: int = MIN_CHARS) -> np.ndarray:
    """The filter of keys in at least two documents, as bytes; a superset, as Bloom filters are.

    ``texts`` has one binary column without NULL. What comes to the driver is ``bits / 8`` bytes.
    """
    slice_bits = min(bits, SLICE_BITS)
    parts = texts.mapInArrow(_task_filters(bits, min_chars, slice_bits), FILTER_SCHEMA)
    for tasks in (F.floor(F.col("task") / MERGE_TASKS), F.lit(0)):
        parts = (parts.withColumn("task", tasks.cast("int")).groupBy("slice", "task")
                 .applyInArrow(_merge, FILTER_SCHEMA))
    found = np.zeros(bits // 8, dtype=np.uint8)
    width = slice_bits // 8
    for row in parts.select("slice", "twice").toLocalIterator():
        found[row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(row["twice"], np.uint8)
    return found


def _suspects(twice, bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = twice.value
        for batch in batches:
            owners: list[int] = []
            keys: list[bytes] = []
            lines: list[int] = []
            for row, text in enumerate(batch.column("text")):
                for number, key in line_keys(text.as_buffer().to_pybytes(), min_chars):
                    owners.append(row)
                    keys.append(key)
                    lines.append(number)
            if not keys:
                continue
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))
            at = positions(hashes, bits).astype(np.int64)
            picked = np.flatnonzero(((seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0))
            if len(picked):
                rows = pa.array(np.asarray(owners)[picked])
                yield pa.RecordBatch.from_pydict({
                    "doc": batch.column("doc").take(rows), "row": batch.column("row").take(rows),
                    "line": pa.array(np.asarray(lines)[picked].astype(np.int32)),
                    "key": pa.array([hashlib.sha256(keys[i]).digest()[:16] for i in picked], pa.binary())})
    return run


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               bits: int = FILTER_BITS, scratch: Scratch | None = None) -> DataFrame:
    """Drop lines that many documents share, but for one document that keeps them.

    Texts are split at newlines. The key of a line is the line without ASCII white space at its ends,
    A-Z lower-cased. A key of at least ``min_chars`` code points found in at least ``min_docs`` different
    ``doc_id`` loses all its lines except in the largest ``doc_id`` that holds it. Returns all columns of
    ``docs``, ``text`` with the lines that stay, and ``n_lines``, ``n_dropped`` (long); columns of these
    names are replaced.

    NULL text stays NULL and counts as one empty line, like an empty text. Rows with a NULL ``doc_id`` are
    no documents: they keep all lines and count for none. Rows that share a ``doc_id`` are one document.
    An empty table gives an empty result. Keys are compared by 128 bits of their SHA-256.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "line-dedup")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    raw = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("row"),
                      F.col("text").cast("binary").alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    twice = spark.sparkContext.broadcast(twice_seen(raw.select("text"), bits, min_chars))
    suspects = scratch.table(raw.mapInArrow(_suspects(twice, bits, min_chars),
                                            f"doc {doc_type}, row long, line int, key binary"))
    holders = suspects.groupBy("key", "doc").agg(F.lit(1).alias("one"))
    shared = (holders.groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
              .where(F.col("n") >= min_docs).select("key", "keeper"))
    # A key that many documents hold is one large partition of this join, which the planner splits.
    dropped = (suspects.join(shared, "key").where(F.col("doc") != F.col("keeper"))
               .groupBy("doc", "row").agg(F.collect_set("line").alias("lines")))

    id_name, row_name, lines_name = (free_name(docs.columns, n) for n in ("_doc", "_row", "_lines"))
    dropped = dropped.toDF(id_name, row_name, lines_name)
    joined = docs.join(dropped, (F.col("doc_id") == F.col(id_name))
                       & (F.xxhash64("text") == F.col(row_name)), "left")
    all_name = free_name(joined.columns, "_all")
    joined = joined.withColumn(all_name, F.split(text_of(), "\n", -1))
    total = F.size(all_name)
    kept = F.array_except(F.sequence(F.lit(0), total - 1), F.col(lines_name))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col(all_name), i)), "\n")
    result = {"text": F.when(F.col(lines_name).isNull(), F.col("text")).otherwise(text),
              "n_lines": total.cast("long"),
              "n_dropped": F.coalesce(F.size(lines_name), F.lit(0)).cast("long")}
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", "text")]
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    found = joined.select(*others, *[column.alias(name) for name, column in result.items()])
    return found.select(*[f"`{c}`" for c in order], "n_lines", "n_dropped")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(text_of(), 256).alias("kept_sha256"))


OP7_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr
  FROM documents),
keyed AS (
  SELECT doc_id, nr, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   '{UPPER}', '{LOWER}') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (
  SELECT k.doc_id, k.nr, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op7_line_dedup": op7_line_dedup}
ORACLE = {"op7_line_dedup": OP7_SQL}
