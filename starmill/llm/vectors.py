"""Integer vectors: which rows take part, how they reach a task, and the best scores of many queries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmill.operators.keys import assign_keys
from starmill.sources.shared import Scratch

STEPS = 256
# Components of queries that a task holds at a time; so many rows a task reads.
BLOCK_BYTES = 16 << 20
ROWS_PER_TASK = 2_000_000
# Rows that models are fitted on: those whose number hashes lowest.
SAMPLE_ROWS = 4096

NO_ID = np.iinfo(np.int64).max
NO_SCORE = np.iinfo(np.int64).min


def _usable(x: Column) -> Column:
    x = x.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def integer_vectors(rows: DataFrame, vector: str, scratch: Scratch) -> DataFrame:
    """A written table of the rows that can be compared, with a unique ``row`` and their integers ``v``.

    ``v`` is floor(256 * x) of each component, ``length`` the vector's Euclidean length. Left out are
    vectors that are NULL or hold a NULL, NaN or infinite component.
    """
    taken = rows.where(F.col(vector).isNotNull() & F.forall(vector, _usable))
    integers = F.transform(vector, lambda x: F.floor(x.cast("double") * STEPS))
    taken = taken.withColumn("v", integers).drop(vector)
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return scratch.table(taken.withColumns(
        {"length": F.sqrt(squares), "row": F.monotonically_increasing_id()}))


def widest(vectors: DataFrame) -> int:
    """Components of the longest vector; shorter ones are read as if zeros followed."""
    return vectors.agg(F.max(F.size("v"))).first()[0] or 0


def spread(vectors: DataFrame, *order: str | Column) -> DataFrame:
    """Rows over tasks of at most about ``ROWS_PER_TASK``; with ``order`` in that order, else by hash."""
    tasks = max(vectors.count() // ROWS_PER_TASK + 1,
                int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if order:
        return vectors.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return vectors.repartition(tasks, "row")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of long as the rows of a matrix, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), dtype=np.int64)
    found[np.arange(width)[None, :] < sizes[:, None]] = values
    return found


def numbers(column: pa.Array, missing: int = NO_ID) -> np.ndarray:
    return column.fill_null(missing).to_numpy()


def _largest(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``; beyond the range of long they saturate."""
    bound = _largest(a) * _largest(b) * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, NO_SCORE + 1, NO_ID).astype(np.int64)


def paired_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of row i of ``a`` with row i of ``b``; beyond the range of long they saturate."""
    if _largest(a) * _largest(b) * a.shape[1] < 1 << 63:
        return np.einsum("ij,ij->i", a, b)
    exact = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.clip(exact, NO_SCORE + 1, NO_ID).astype(np.int64)


class Best:
    """The ``k`` best (score, id, row) of each of ``n`` queries; ties go to the smaller id, then row.

    The largest long stands for a missing id, which comes last.
    """

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NO_SCORE, dtype=np.int64)
        self.id = np.full((n, k), NO_ID, dtype=np.int64)
        self.row = np.full((n, k), NO_ID, dtype=np.int64)

    def least(self) -> np.ndarray:
        """The score of the last of the k best of each query."""
        return self.score[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(query):
            return
        touched, at = np.unique(query, return_inverse=True)
        of = np.concatenate([np.repeat(np.arange(len(touched)), self.k), at])
        columns = [np.concatenate([kept[touched].ravel(), new])
                   for kept, new in ((self.score, score), (self.id, ids), (self.row, rows))]
        order = np.lexsort((columns[2], columns[1], ~columns[0], of))
        begins = np.searchsorted(of[order], np.arange(len(touched)))
        first = order[begins[:, None] + np.arange(self.k)]
        self.score[touched], self.id[touched], self.row[touched] = (c[first] for c in columns)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Query, score, id and row of all that was found."""
        query, place = np.nonzero(self.score != NO_SCORE)
        return query, self.score[query, place], self.id[query, place], self.row[query, place]


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def sample(vectors: DataFrame, columns: Sequence[str], rows: int = SAMPLE_ROWS) -> pa.Table:
    """A bounded sample of rows for fitting, the same for the same table."""
    return vectors.orderBy(F.xxhash64("row"), "row").limit(rows).select(*columns).toArrow()


def blocks(queries: DataFrame, width: int, columns: Sequence[str], scratch: Scratch) -> Iterator[pa.Table]:
    """All of ``queries``, at most ``BLOCK_BYTES`` of components at a time."""
    size = max(1, BLOCK_BYTES // (8 * max(width, 1)))
    numbered = scratch.table(assign_keys(queries, ["row"], "nth", scratch=scratch))
    count = numbered.agg(F.max("nth")).first()[0] or 0
    for begin in range(0, count, size):
        yield numbered.where(F.col("nth").between(begin + 1, begin + size)).select(*columns).toArrow()
