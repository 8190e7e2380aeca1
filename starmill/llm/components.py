"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmill.sources.shared import Scratch

# Links that one task may hold; more are worked on by stars.
LINKS_IN_A_TASK = 1 << 20


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """One step of alternating stars: neighbours move to the smallest node they share with ``u``.

    ``links`` has ``u`` > ``v``. The large star moves neighbours above ``u``, the small star those below
    and ``u`` itself; links never leave their component, and every step makes them point lower.
    """
    around = links.union(links.select("v", "u")) if larger else links
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = around.join(least, "u")
    if larger:
        found = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        found = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v")))
    return found.where("u <> v").groupBy("u", "v").agg(F.lit(1)).select("u", "v")


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links and for each the smallest node that links lead to."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = np.split(place, 2)
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (root != root[root]).any():
            root = root[root]
    return nodes, nodes[root]


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links = list(batches)
    if links:
        columns = pa.Table.from_batches(links)
        nodes, least = smallest_reachable(*[columns.column(c).to_numpy() for c in ("u", "v")])
        larger = nodes != least
        kind = columns.schema.field("u").type
        yield pa.RecordBatch.from_pydict({"node": pa.array(nodes[larger], kind), "component": pa.array(least[larger], kind)})


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node with a smaller one.

    ``links`` has two columns of ids. Up to ``LINKS_IN_A_TASK`` links are solved by one task; more by rounds
    of stars. Each round is written, so the lineage stays short; when a round changes nothing, every link
    leads straight to the smallest node. Both ways give the same result.
    """
    a, b = links.columns
    now = scratch.table(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    if now.count() <= LINKS_IN_A_TASK:
        kind = now.schema["u"].dataType.simpleString()
        return scratch.table(now.coalesce(1).mapInArrow(_in_one_task, f"node {kind}, component {kind}"))
    state = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state or not found[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = tuple(found)
        now = scratch.table(_stars(_stars(now, larger=True), larger=False))
