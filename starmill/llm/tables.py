"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.sources.tables import read_table

# ASCII white space, as in the character class [\x20\x09-\x0D].
BLANKS = b" \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")

# Rows handed to Python at a time are regrouped so that a few very long texts do not meet in one slice.
SLICE_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def text_of(column: str = "text") -> Column:
    """The text, with NULL as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until it differs from all of ``taken``, whatever the case."""
    lowered = {name.lower() for name in taken}
    while wanted.lower() in lowered:
        wanted = "_" + wanted
    return wanted


class Carried:
    """An object of this library sent to all tasks, with its code, so that they need not import the library.

    ``value`` puts it together anew; a task reads it once.
    """

    def __init__(self, spark: SparkSession, value):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return cloudpickle.loads(self._packed.value)


def released(task):
    """``task`` for ``mapInArrow``, after which the worker gives back memory that it no longer uses.

    Workers go on to tasks of other stages, and what one stage has needed at most would stay theirs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library offers it
            if trim is not None:
                trim(0)
    return run


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose texts in ``column`` hold about ``limit`` bytes each; never empty ones."""
    sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)] \
        if batch.nbytes > limit else []
    begin = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    if batch.num_rows > begin:
        yield batch.slice(begin)
