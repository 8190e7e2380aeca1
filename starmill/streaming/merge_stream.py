"""The type 1 merge fed by a stream of new source files."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from starmill.operators.lookup import one_per_key
from starmill.operators.merge import scd1_merge
from starmill.sources.shared import Scratch
from starmill.sources.store import Store

KEPT_VERSIONS = 3


def merge_batch(store: Store, table: str, schema: StructType, batch: DataFrame, batch_id: int,
                keys: Sequence[str], attributes: Sequence[str], newest_by: Sequence[str],
                stream: str = "stream") -> None:
    """Merge one micro-batch and publish the result as the table's next version.

    Batches may be delivered twice, files may arrive out of order, and other streams may write to the same
    table. A version belongs to the batch that claimed its number, so a batch that has one is done. If
    another stream takes the number first, the batch is merged again into what that has written: no version
    ever leaves out one before it. Only rows newer by all of ``newest_by`` than the stored one change it,
    so a batch delivered after its version was dropped changes nothing. Older versions are dropped but for
    a few.
    """
    owner = f"{stream}-{batch_id}"
    if owner in store.owners(table):
        return
    with Scratch(store.spark, "batch") as scratch:
        newest = scratch.table(one_per_key(
            batch.select(*dict.fromkeys([*keys, *newest_by, *attributes])), keys, newest_by))
        while True:
            base = max(store.versions(table), default=0)
            target = store.read(table, schema, version=base)
            merge = scd1_merge(target, newest, keys, attributes, stamps={}, newer_by=newest_by)
            if store.publish(table, merge.table.drop("action"), base, owner):
                break
    store.prune(table, keep=KEPT_VERSIONS)


def start_merge_stream(spark: SparkSession, source: str, source_schema: StructType, store: Store,
                       table: str, keys: Sequence[str], attributes: Sequence[str],
                       newest_by: Sequence[str], checkpoint: str,
                       files_per_batch: int = 1000) -> StreamingQuery:
    """Process every file that is in ``source`` and not yet recorded in ``checkpoint``, then stop."""
    columns = [*keys, *attributes, *newest_by]
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    schema = StructType([source_schema[c] for c in dict.fromkeys(columns)])
    stream = (spark.readStream.schema(source_schema)
              .option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
              .parquet(source))
    return (stream.writeStream
            .foreachBatch(lambda batch, batch_id: merge_batch(
                store, table, schema, batch, batch_id, keys, attributes, newest_by, name))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
