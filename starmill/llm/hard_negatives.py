"""Hard negatives by an inverted multi-index.

Vectors are cut into two halves, each with a codebook of its own; a vector's two codes are its cell. By
Cauchy and Schwarz a half scores at most its codeword's score plus the anchor half's length times the
codeword's radius, the largest distance of a half from it. The two lists of half bounds, each in descending
order, are merged by a heap, which visits the cells by the sum of both bounds. A search ends once the next
bound is below what it still needs: the score of its last wanted row, or the lower end of its window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starmill.llm.vectors import (
    Best, blocks, id_array, integer_vectors, matrix, numbers, products, sample, spread, widest)
from starmill.sources.shared import Scratch
from starmill.sources.tables import read_table

POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
ANCHOR_STEP = 100
CODES, ROUNDS = 16, 12
# Rows of an index that a task holds, and rows that are scored at a time.
INDEX_ROWS, ROWS_AT_A_TIME = 16_384, 1024
_ROUNDING = 1e-9

POSITIVE = "anchor_row long, anchor_id long, score long, positive_id long, row long"
NEGATIVE = "anchor_row long, place int, score long, negative_id long, row long"


def codebook(halves: np.ndarray, codes: int = CODES, rounds: int = ROUNDS) -> np.ndarray:
    """Codewords by k-means; at least one, at most as many as there are different halves."""
    different = np.unique(halves, axis=0).astype(np.float64)
    if not len(different):
        return np.zeros((1, halves.shape[1]))
    words = np.random.default_rng(13).permutation(different)[:codes]
    for _ in range(rounds):
        code = nearest(halves, words)[0]
        members = np.bincount(code, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, code, halves)
        words = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], words)
    return words


def nearest(halves: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of the nearest codeword and the distance from it."""
    halves = halves.astype(np.float64)
    code = ((words ** 2).sum(axis=1) - 2 * halves @ words.T).argmin(axis=1)
    return code, np.sqrt(((halves - words[code]) ** 2).sum(axis=1))


def cells_by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of places in two descending lists, in descending order of the sums; (sum, i, j)."""
    heap = [(-(first[0] + second[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, i, j
        if j + 1 < len(second):
            heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))


class Index:
    """Rows by cell and label, with the bounds of the cells for a block of anchors."""

    def __init__(self, vectors, labels, ids, rows, codes, distances, words, anchors):
        n_second = len(words[1])
        cell = codes[0] * n_second + codes[1]
        order = np.lexsort((labels, cell))
        self.vectors, self.labels, self.ids, self.rows = vectors[order], labels[order], ids[order], rows[order]
        self._cell, self._ranges = cell[order], {}
        self._cells = np.arange(len(words[0]) * n_second)
        half = vectors.shape[1] // 2
        self.order, self.bound, self.sure = [], [], []
        for side, u in enumerate((anchors[:, :half], anchors[:, half:])):
            radius = np.full(len(words[side]), -1.0)
            np.maximum.at(radius, codes[side], distances[side])
            present = np.flatnonzero(radius >= 0)
            centre, reach = u @ words[side][present].T, np.linalg.norm(u, axis=1)[:, None] * radius[present]
            by_bound = np.argsort(-(centre + reach), axis=1, kind="stable")
            self.order.append(present[by_bound])
            self.bound.append(np.take_along_axis(centre + reach, by_bound, axis=1))
            self.sure.append(np.take_along_axis(centre - reach, by_bound, axis=1))
        self._n_second = n_second

    def ranges(self, label: int | None) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of each cell's rows, of one label or of all."""
        if label not in self._ranges:
            if label is None:
                ends = [np.searchsorted(self._cell, self._cells, side) for side in ("left", "right")]
            else:
                of_label = np.flatnonzero(self.labels == label)
                ends = [np.searchsorted(self._cell[of_label], self._cells, side) for side in ("left", "right")]
                # Rows of a label lie side by side in each cell.
                at = np.append(of_label, len(self.labels))
                count = ends[1] - ends[0]
                ends = [at[ends[0]], at[ends[0]] + count]
            self._ranges[label] = tuple(e.tolist() for e in ends)
        return self._ranges[label]

    def visit(self, anchor: int, label: int | None, highest: float, needed) -> Iterator[np.ndarray]:
        """Places of rows in groups, cells with the higher bounds first, until ``needed()`` is above them.

        Cells whose rows all score above ``highest`` are passed over.
        """
        begins, ends = self.ranges(label)
        first, second = (self.order[s][anchor].tolist() for s in (0, 1))
        bounds = [self.bound[s][anchor].tolist() for s in (0, 1)]
        sure = [self.sure[s][anchor].tolist() for s in (0, 1)]
        slack = 1e-6 + _ROUNDING * (abs(bounds[0][0]) + abs(bounds[1][0]) + abs(bounds[0][-1]) + abs(bounds[1][-1]))
        waiting, held = [], 0
        for bound, i, j in cells_by_bound(*bounds):
            if bound + slack < needed():
                break
            cell = first[i] * self._n_second + second[j]
            size = ends[cell] - begins[cell]
            if size and sure[0][i] + sure[1][j] - slack <= highest:
                waiting.append(np.arange(begins[cell], ends[cell]))
                held += size
                if held >= ROWS_AT_A_TIME:
                    yield np.concatenate(waiting)
                    waiting, held = [], 0
        if waiting:
            yield np.concatenate(waiting)


def _indexed(model, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, half = model.value, width // 2
        for batch in batches:
            vectors = matrix(batch.column("v"), width)
            codes, distances = zip(*[nearest(part, w) for part, w in zip((vectors[:, :half], vectors[:, half:]), words)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c.astype(np.int32)) for c in codes], *[pa.array(d) for d in distances]],
                names=[*batch.schema.names, "first", "second", "first_distance", "second_distance"])
    return run


def _indexes(batches: Iterator[pa.RecordBatch], words, anchors: np.ndarray, width: int) -> Iterator[Index]:
    """An index over every ``INDEX_ROWS`` rows of a task."""
    def built(parts):
        table = pa.Table.from_batches(parts)
        column = {n: table.column(n).combine_chunks() for n in table.column_names}
        return Index(matrix(column["v"], width), column["label"].to_numpy(), numbers(column["id"]),
                     column["row"].to_numpy(), [column[c].to_numpy() for c in ("first", "second")],
                     [column[c].to_numpy() for c in ("first_distance", "second_distance")], words, anchors)

    parts, held = [], 0
    for whole in batches:
        for at in range(0, whole.num_rows, INDEX_ROWS):
            batch = whole.slice(at, INDEX_ROWS)
            if held and held + batch.num_rows > INDEX_ROWS:
                yield built(parts)
                parts, held = [], 0
            parts.append(batch)
            held += batch.num_rows
    if parts:
        yield built(parts)


def _positives(model, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, vectors, labels, ids, rows = model.value
        best = Best(len(rows), k)
        for index in _indexes(batches, words, vectors, width):
            for a in range(len(rows)):
                for at in index.visit(a, int(labels[a]), np.inf, lambda: best.score[a, -1]):
                    at = at[index.rows[at] != rows[a]]
                    score = products(index.vectors[at], vectors[a:a + 1])[:, 0]
                    best.add(np.full(len(at), a), score, index.ids[at], index.rows[at])
        anchor, score, found, found_rows = best.found()
        yield pa.RecordBatch.from_pydict({
            "anchor_row": pa.array(rows[anchor]), "anchor_id": id_array(ids[anchor]), "score": pa.array(score),
            "positive_id": id_array(found), "row": pa.array(found_rows)})
    return run


def _negatives(model, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, vectors, labels, rows, low, high = model.value
        places = low.shape[1]
        best = Best(len(rows) * places, k)
        for index in _indexes(batches, words, vectors, width):
            for a in range(len(rows)):
                windows = np.arange(a * places, (a + 1) * places)

                def needed() -> np.ndarray:
                    return np.maximum(low[a], best.score[windows, -1])

                highest = high[a].max()
                for at in index.visit(a, None, highest, lambda: needed().min()):
                    score = products(index.vectors[at], vectors[a:a + 1])[:, 0]
                    least = needed()
                    wanted = (score >= least.min()) & (score <= highest) & (index.labels[at] != labels[a])
                    at, score = at[wanted], score[wanted]
                    window, row = np.nonzero((score >= least[:, None]) & (score <= high[a][:, None]))
                    best.add(windows[window], score[row], index.ids[at[row]], index.rows[at[row]])
        window, score, found, found_rows = best.found()
        yield pa.RecordBatch.from_pydict({
            "anchor_row": pa.array(rows[window // places]), "place": pa.array((window % places).astype(np.int32)),
            "score": pa.array(score), "negative_id": id_array(found), "row": pa.array(found_rows)})
    return run


def hard_negatives(rows: DataFrame, is_anchor: str, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, vector: str = "embedding",
                   scratch: Scratch | None = None) -> DataFrame:
    """Rows of other labels that score nearly as high with an anchor as its best rows of the same label.

    Components are the integers floor(256 * x), a score is their inner product. The positives of an anchor
    (a row that meets the SQL condition ``is_anchor``) are the ``positives`` other rows of its label that
    score highest; for each, the ``negatives`` highest rows of other labels with ``low`` * positive <=
    100 * negative <= ``high`` * positive are returned: ``anchor_id``, ``positive_id``, ``rank`` from 1,
    ``negative_id``, ``positive_score``, ``negative_score``. Equal scores are in the order of ``vec_id``.

    Rows with a NULL label or a vector that is NULL or holds a NULL, NaN or infinite component take no part.
    Vectors of unequal size are compared as if zeros followed the shorter one. Every row is its own: copies
    of an anchor, also under its ``vec_id``, are other rows. A row without ``vec_id`` comes last among equal
    scores (and so does the id 2**63 - 1, which is given back as NULL). Scores beyond the range of long are
    cut to it. An anchor without positives, and a positive without negatives, has no row. An empty table
    gives an empty result. Columns other than ``vec_id``, ``label`` and the vector serve the condition only.

    Every row is indexed; the codebooks are fitted on ``SAMPLE_ROWS`` rows and decide speed only. Anchors are
    handed to tasks in blocks of bounded size, each block in two passes over the index.
    """
    spark = rows.sparkSession
    scratch = scratch or Scratch(spark, "hard-negatives")
    marked = rows.where("label IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col(vector).alias("x"), F.coalesce(F.expr(is_anchor), F.lit(False)).alias("asks"))
    vectors = integer_vectors(marked, "x", scratch)
    width = widest(vectors)
    seeds = matrix(sample(vectors, ["v"]).column("v"), width)
    words = [codebook(part) for part in (seeds[:, :width // 2], seeds[:, width // 2:])]
    books = spark.sparkContext.broadcast(words)
    index = scratch.table(spread(vectors.select("row", "id", "label", "v")).mapInArrow(
        _indexed(books, width), "row long, id long, label long, v array<long>, first int, second int,"
                                " first_distance double, second_distance double"))

    def first(found: DataFrame, keys: list[str], ident: str, k: int) -> DataFrame:
        """The k best of all tasks, each of which has sent at most k rows a key."""
        best_first = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col(ident).asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    parts = [spark.createDataFrame([], result)]
    anchors = vectors.where("asks").select("id", "row", "label", "v")
    for block in blocks(anchors, width, ["id", "row", "label", "v"], scratch):
        own = [matrix(block.column("v"), width), block.column("label").to_numpy()]
        own_rows = block.column("row").to_numpy()
        model = spark.sparkContext.broadcast((words, *own, numbers(block.column("id")), own_rows))
        found = scratch.table(index.mapInArrow(_positives(model, width, positives), POSITIVE))
        model.destroy()
        known = scratch.table(first(found, ["anchor_row"], "positive_id", positives).withColumn("place", F.col("rank") - 1))
        # At most `positives` windows for each anchor of the block; a window that no score meets where there are fewer.
        scores = known.select("anchor_row", "place", "score").toArrow()
        least = np.full((len(own_rows), positives), np.iinfo(np.int64).max, dtype=np.int64)
        most = np.full((len(own_rows), positives), np.iinfo(np.int64).min, dtype=np.int64)
        at = np.argsort(own_rows)
        a = at[np.searchsorted(own_rows, scores.column("anchor_row").to_numpy(), sorter=at)]
        p = scores.column("place").to_numpy()
        # Whole numbers of any size: ceil(low * s / 100) and floor(high * s / 100).
        exact = [int(s) for s in scores.column("score").to_pylist()]
        least[a, p], most[a, p] = [-(-low * s // 100) for s in exact], [high * s // 100 for s in exact]
        model = spark.sparkContext.broadcast((words, *own, own_rows, least, most))
        hard = scratch.table(index.mapInArrow(_negatives(model, width, negatives), NEGATIVE))
        model.destroy()
        ranked = first(hard, ["anchor_row", "place"], "negative_id", negatives)
        parts.append(ranked.withColumnRenamed("score", "negative_score").drop("row")
                     .join(known.select("anchor_row", "place", "anchor_id", "positive_id",
                                        F.col("score").alias("positive_score")), ["anchor_row", "place"])
                     .select(*spark.createDataFrame([], result).columns))
    return reduce(DataFrame.unionByName, parts)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with the label of every seventh taken one further."""
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), f"vec_id % {ANCHOR_STEP} = 0")


QUERIES = {"op13_hard_negatives": op13_hard_negatives}

ORACLE = {"op13_hard_negatives": f"""
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND label IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
               CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
        FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id WHERE a.vec_id % {ANCHOR_STEP} = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
    SELECT p.anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
         AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
    QUALIFY rank <= {NEGATIVES}"""}
