"""Counts taken by a write itself, so that nothing has to be read again for them."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


class Figures:
    """Aggregates over ``df`` that the write of ``rows`` takes in passing.

    ``rows`` are to be written without a further shuffle: then they are counted by the tasks that write
    them, each once. Tasks before a shuffle may run again for a lost executor and count twice.
    """

    def __init__(self, df: DataFrame, **figures: Column):
        self._observation = Observation()
        self.rows = df.observe(self._observation, *[c.alias(n) for n, c in figures.items()])

    def __getitem__(self, name: str):
        """A figure, after the write; None if the planner found that there is nothing to write."""
        try:
            return self._observation.get[name]
        except (Py4JJavaError, KeyError):  # a plan known to be empty is replaced, its figures with it
            return None

    @property
    def count(self) -> int:
        return self["count"] or 0
