"""Exact search for the largest inner products.

Vectors are taken in the order of their lengths, longest first, so that by Cauchy and Schwarz a query is
done with all further ones once its length times theirs falls below its k-th best score. Before that, a
product is summed up in parts along the directions of a singular value decomposition, which come first
where the vectors are widest spread; a pair is dropped as soon as its partial sum and the product of the
lengths of what is left stay below the k-th best score. What remains is computed exactly on the integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starmill.llm.vectors import (
    NO_SCORE, Best, blocks, id_array, integer_vectors, matrix, numbers, paired_products, products, sample, spread,
    widest)
from starmill.sources.shared import Scratch
from starmill.sources.tables import read_table

BEST = 5
QUERY_STEP = 50
# Rows and queries that are multiplied at a time, and the parts of the dimensions they are summed over.
ROWS, QUERIES_AT_A_TIME, PARTS = 2048, 512, 4
# Pairs are looked at one by one as soon as at most this share is left.
FEW = 0.02
PAIRS = 1 << 16
_ROUNDING = 1e-9

RESULT = "query_row long, query_id long, score long, vec_id long, row long"


def rotation(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal directions as columns, those that the vectors are widest spread along first."""
    return np.linalg.eigh(vectors.T.astype(np.float64) @ vectors)[1][:, ::-1]


def remaining_lengths(rotated: np.ndarray) -> np.ndarray:
    """Column ``i``: the length of each row without its first ``i`` components."""
    squares = np.cumsum(rotated[:, ::-1] ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(rotated), 1))]))


class Queries:
    """A block of queries, turned by the rotation, with a score that each one's k-th best reaches for sure."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, floors: np.ndarray, turn: np.ndarray):
        self.vectors, self.rows, self.floors, self.turn = vectors, rows, floors, turn
        self.turned = vectors @ turn
        self.left = remaining_lengths(self.turned)

    def search(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, best: Best) -> None:
        """Enter into ``best`` what the given vectors, in descending order of length, add to it."""
        turned = vectors @ self.turn
        left = remaining_lengths(turned)
        width = turned.shape[1]
        ends = sorted({max(1, width * (i + 1) // PARTS) for i in range(PARTS)}) if width else []
        wanted = np.maximum(best.least(), self.floors)
        longest = left[:, 0].max(initial=0)
        open_queries = np.flatnonzero(self.left[:, 0] * longest * (1 + _ROUNDING) + 1e-6 >= wanted)
        for at in range(0, len(open_queries), QUERIES_AT_A_TIME):
            block = open_queries[at:at + QUERIES_AT_A_TIME]
            slack = _ROUNDING * self.left[block, 0] * longest + 1e-6
            least = (wanted[block] - slack)[:, None]
            sums = np.zeros((len(block), len(vectors)))
            near, begin = np.ones(sums.shape, dtype=bool), 0
            for end in ends:
                sums += self.turned[block, begin:end] @ turned[:, begin:end].T
                near = sums + self.left[block, end][:, None] * left[:, end] >= least
                begin = end
                if np.count_nonzero(near) <= FEW * near.size:
                    break
            query, row = np.nonzero(near)
            if len(query) > 0.2 * near.size:
                score = products(self.vectors[block], vectors)[query, row]
            else:
                score = np.concatenate([np.empty(0, dtype=np.int64), *[
                    paired_products(self.vectors[block[query[i:i + PAIRS]]], vectors[row[i:i + PAIRS]])
                    for i in range(0, len(query), PAIRS)]])
            query = block[query]
            good = (score >= wanted[query]) & (self.rows[query] != rows[row])
            best.add(query[good], score[good], ids[row[good]], rows[row[good]])


def _floors(vectors: np.ndarray, rows: np.ndarray, known: np.ndarray, known_rows: np.ndarray, k: int) -> np.ndarray:
    """For each query the k-th best score among the sampled rows but its own."""
    floors = np.full(len(vectors), NO_SCORE, dtype=np.int64)
    if len(known) >= k + 1:
        for at in range(0, len(vectors), QUERIES_AT_A_TIME):
            score = products(vectors[at:at + QUERIES_AT_A_TIME], known)
            score[rows[at:at + QUERIES_AT_A_TIME, None] == known_rows] = NO_SCORE
            floors[at:at + QUERIES_AT_A_TIME] = np.partition(score, -k, axis=1)[:, -k]
    return floors


def _with_floors(seeds, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_rows = seeds.value
        for batch in batches:
            vectors, rows = matrix(batch.column("v"), width), batch.column("row").to_numpy()
            floors = pa.array(_floors(vectors, rows, known, known_rows, k), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, floors], names=[*batch.schema.names, "floor"])
    return run


def _found(model, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_vectors, query_ids, query_rows, floors, turn = model.value
        queries, best = Queries(query_vectors, query_rows, floors, turn), Best(len(query_rows), k)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                queries.search(matrix(batch.column("v"), width), numbers(batch.column("id")),
                               batch.column("row").to_numpy(), best)
        query, score, ids, rows = best.found()
        yield pa.RecordBatch.from_pydict({
            "query_row": pa.array(query_rows[query]), "query_id": id_array(query_ids[query]),
            "score": pa.array(score), "vec_id": id_array(ids), "row": pa.array(rows)})
    return run


def top_products(rows: DataFrame, is_query: str, k: int = BEST, vector: str = "embedding",
                 scratch: Scratch | None = None) -> DataFrame:
    """The ``k`` rows with the largest inner products of every row that meets the SQL condition ``is_query``.

    Components are the integers floor(256 * x). Returns ``query_id``, ``rank`` from 1, ``vec_id`` and
    ``score``; equal scores are in the order of ``vec_id``, and a query with fewer than ``k`` other rows
    gets them all. ``rows`` needs ``vec_id`` and the vector column; other columns serve the condition only.

    Vectors that are NULL or hold a NULL, NaN or infinite component take no part. Vectors of unequal size
    are compared as if zeros followed the shorter one; an empty one scores 0 with all. Every row is a
    candidate of every query but of itself, so of repeated rows each has an answer, with the others in it.
    A row without ``vec_id`` comes last among equal scores (and so does the id 2**63 - 1, which is given back
    as NULL). Scores beyond the range of long are cut to it. An empty table gives an empty result.

    Queries are handed to tasks ``BLOCK_BYTES`` at a time, each block in a pass over all rows; the sample
    that the rotation and the first bounds come from has ``SAMPLE_ROWS`` rows and decides speed only.
    """
    spark = rows.sparkSession
    scratch = scratch or Scratch(spark, "exact-search")
    marked = rows.select(F.col("vec_id").cast("long").alias("id"), F.col(vector).alias("x"),
                         F.coalesce(F.expr(is_query), F.lit(False)).alias("asks"))
    vectors = integer_vectors(marked, "x", scratch)
    width = widest(vectors)
    by_length = scratch.table(spread(vectors.drop("asks"), F.col("length").desc(), F.col("row")))

    seeds = sample(vectors, ["v", "row"])
    known = matrix(seeds.column("v"), width)
    turn = rotation(known)
    seeds = spark.sparkContext.broadcast((known, seeds.column("row").to_numpy()))
    queries = vectors.where("asks").select("id", "row", "v").mapInArrow(
        _with_floors(seeds, width, k), "id long, row long, v array<long>, floor long")
    parts = [spark.createDataFrame([], RESULT)]
    for block in blocks(queries, width, ["id", "row", "v", "floor"], scratch):
        model = spark.sparkContext.broadcast((
            matrix(block.column("v"), width), numbers(block.column("id")), block.column("row").to_numpy(),
            block.column("floor").to_numpy(), turn))
        parts.append(scratch.table(by_length.select("id", "row", "v").mapInArrow(_found(model, width, k), RESULT)))
        model.destroy()
    # At most k rows of a query from each task.
    best_first = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read_table(spark, sf_dir, "embeddings"), f"vec_id % {QUERY_STEP} = 0")


QUERIES = {"op12_exact_top_k": op12_exact_top_k}

ORACLE = {"op12_exact_top_k": f"""
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_STEP} = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored QUALIFY rank <= {BEST}"""}
