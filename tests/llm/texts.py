"""Small tables and plain reference methods for the tests of the text operators."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


def prose(seed, words, vocabulary=400):
    source = random.Random(seed)
    return " ".join(f"w{source.randrange(vocabulary)}x" for _ in range(words))


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def awkward(spark):
    """NULLs, empty, blank and long texts, repeated rows, a shared id, and columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "word " * 30_000), (6, prose(1, 60)), (6, prose(1, 60)),
            (7, prose(2, 50)), (7, prose(3, 50)), (None, prose(1, 60)), (None, None), (-9, "ünï ß 　 漢字 ...")]
    return (frame(spark, rows).withColumn("_doc", F.lit("mine")).withColumn("n_dropped", F.lit("mine"))
            .withColumn("NODE", F.lit(1)).withColumn("score", F.lit(2)).withColumn("_words", F.lit(3))
            .withColumn("lang", F.lit("xx")))


def empty(spark):
    return awkward(spark).where("doc_id = 123456")
