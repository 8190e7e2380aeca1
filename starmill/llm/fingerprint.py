"""Document fingerprints by threshold-scaled sketches.

A sketch holds the hashes of all word shingles that fall below a fixed share of the hash range. Whether a
shingle is held depends on the shingle alone, so sketches of parts merge into that of the whole, and the
share of a small document's hashes found in a large one's estimates how much of it the large one contains.
All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starmill.llm.tables import documents, free_name, text_of
from starmill.operators.keys import assign_keys
from starmill.sources.shared import Scratch

WORDS_PER_SHINGLE = 5
# One hash in so many is held. A likeness over u different shingles has a standard error of at most
# sqrt(SCALE / u) / 2: 0.1 at 50 shingles, 0.02 at 1000.
SCALE = 2
BLOCK_BITS = 8
LOWEST = -(1 << 63)


def words(text: Column) -> Column:
    """Lower-cased strings between ASCII white space."""
    found = F.split(F.lower(text), r"[\x20\x09-\x0D]+", -1)
    return F.filter(found, lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """64-bit hashes of all shingles of an array of words; of the whole array if it is shorter.

    ``words`` should be a column of its own, so that it is computed once for all shingles.
    """
    width, number = WORDS_PER_SHINGLE, F.size(words)
    many = F.transform(F.sequence(F.lit(0), F.greatest(number - width, F.lit(0))),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(number >= width, many).when(number > 0, F.array(F.xxhash64(F.concat_ws(" ", words)))) \
        .otherwise(F.array().cast("array<bigint>"))


def held(hashes: Column, scale: int = SCALE) -> Column:
    """The sketch: sorted different hashes below one ``scale``-th of the range."""
    last = F.lit(LOWEST + (1 << 64) // scale - 1)
    return F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h <= last)))


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts together, from theirs."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has; NULL if its sketch is empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Estimated Jaccard similarity; where both sketches are empty, 1 if the texts are the ``same``, else 0."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.when(same, 1.0).otherwise(0.0))


def printed(sketch: Column, text_hash: Column) -> Column:
    """The fingerprint as a string: the hash of the whole text, then the sketch, in hexadecimal."""
    return F.lower(F.concat(F.lpad(F.hex(text_hash), 16, "0"), F.lit(":"),
                            F.array_join(F.transform(sketch, lambda h: F.hex(h)), "")))


def with_sketch(rows: DataFrame, text: str, sketch: str, scale: int = SCALE) -> DataFrame:
    """``rows`` with the sketch of column ``text`` as column ``sketch``."""
    name = free_name(rows.columns, "_words")
    return (rows.withColumn(name, words(F.col(text)))
            .withColumn(sketch, held(shingle_hashes(F.col(name)), scale)).drop(name))


def following(ids: DataFrame, scratch: Scratch) -> DataFrame:
    """``id`` and ``follower``, the next larger one, for a column of different ids; after the last the first."""
    numbered = scratch.table(assign_keys(ids.toDF("id"), ["id"], "at", scratch=scratch))
    last = F.lit(numbered.count())
    before = numbered.select(F.col("id").alias("follower"), F.when(F.col("at") == 1, last)
                             .otherwise(F.col("at") - 1).alias("at"))
    return numbered.join(before, "at").select("id", "follower")


def fingerprints_beside_next(docs: DataFrame, scale: int = SCALE, scratch: Scratch | None = None) -> DataFrame:
    """Fingerprints of all texts, of edited texts, and their likeness to these and to the next document.

    An edited text has its last quarter (whole code points) replaced by the first as many of the document
    with the next larger ``doc_id`` (an integer), or all if that has fewer; after the last comes the first.
    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next`` a row of ``docs``.

    NULL texts are empty. Rows that share a ``doc_id`` follow each other in the order of their texts. Rows
    with a NULL ``doc_id`` have no next document: their text is not edited and ``near_next`` is NULL. Other
    columns are not looked at. An empty table gives an empty result.

    Neighbours are found in blocks of ``1 << BLOCK_BITS`` ids, so a text is moved once; only the first of
    each block is also sent to the block before.
    """
    scratch = scratch or Scratch(docs.sparkSession, "fingerprints")
    block = F.shiftright("doc", BLOCK_BITS).alias("block")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), text_of().alias("text"))
    placed = rows.where("doc IS NOT NULL").select("doc", "text", block)
    in_block = Window.partitionBy("block").orderBy("doc", "text")
    firsts = (placed.withColumn("nth", F.row_number().over(in_block)).where("nth = 1")
              .select(F.col("block").alias("follower"), F.col("text").alias("first_text")))
    order = following(placed.select("block").distinct(), scratch)
    given = with_sketch(order.join(firsts, "follower").select(F.col("id").alias("block"), "first_text"),
                        "first_text", "first_sketch", scale)
    beside = (with_sketch(placed.repartition("block"), "text", "sketch", scale)
              .withColumn("next", F.lead(F.struct("text", "sketch")).over(in_block)).join(given, "block")
              .select("doc", "text", "sketch", F.coalesce("next.text", "first_text").alias("next_text"),
                      F.coalesce("next.sketch", "first_sketch").alias("next_sketch")))
    apart = with_sketch(rows.where("doc IS NULL"), "text", "sketch", scale)
    both = beside.unionByName(apart, allowMissingColumns=True)

    size, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.when(F.col("next_text").isNull(), F.col("text")).otherwise(
        F.concat(F.substring("text", F.lit(1), size - quarter), F.substring("next_text", F.lit(1), quarter)))
    both = with_sketch(both.withColumn("edited", edited), "edited", "edited_sketch", scale)
    own, other = F.xxhash64("text"), F.xxhash64("edited")
    return both.select(
        F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"), size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("sketch"), own).alias("fingerprint"),
        printed(F.col("edited_sketch"), other).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), own == other).alias("near_edited"),
        F.when(F.col("next_sketch").isNotNull(), likeness(F.col("sketch"), F.col("next_sketch"),
                                                          own == F.xxhash64("next_text"))).alias("near_next"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_beside_next(documents(spark, sf_dir))


QUERIES = {"op4_fingerprints": op4_fingerprints}
ORACLE: dict[str, str] = {}
