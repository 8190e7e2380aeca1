"""A cleaning pipeline over ``documents``: stages of the text operators, run one after the other.

Each stage takes what the one before it kept, written as Parquet and read back, so that its lineage ends
there and lost executors cost no more than the stage at work. Filters drop whole rows and keep all columns;
the last stage gives the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm import packing
from starmill.llm.decontaminate import without_passages
from starmill.llm.language import bucket
from starmill.llm.line_dedup import line_dedup
from starmill.llm.near_dedup import one_of_each
from starmill.llm.tables import documents
from starmill.llm.toxicity import FOLDS, HELD_OUT, learn, without_toxic
from starmill.sources.shared import Scratch
from starmill.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Documents with this share of their word shingles in common are near duplicates.
SIMILAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go; it learns from two folds of the labels in three."""
    labels = read_table(spark, sf_dir, "labels").where(bucket("doc_id", FOLDS) != HELD_OUT)
    return without_toxic(docs, learn(docs, labels))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; ``n_chars`` follows the text."""
    return (line_dedup(docs).select(*[f"`{c}`" for c in docs.columns])
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity the one with the smallest id stays."""
    return one_of_each(docs, SIMILAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in full sequences of tokens."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# The toxicity network is trained in numpy, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole of ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
