"""The merge fed by files that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.registry.context import table
from starmill.sources.shared import fresh_dir
from starmill.sources.store import Store
from starmill.streaming.merge_stream import start_merge_stream

FILES_PER_BATCH = 10


def merge_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as files by day, then streamed into a table of one row per user."""
    area = fresh_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    (events.withColumn("day", F.col("ts").cast("date")).write.partitionBy("day")
     .parquet(f"{area}/incoming"))
    store = Store(spark, f"{area}/store")
    query = start_merge_stream(
        spark, f"{area}/incoming", events.schema, store, "last_seen", keys=["user_id"],
        attributes=["event_type"], newest_by=["ts", "event_id"], checkpoint=f"{area}/checkpoint",
        files_per_batch=FILES_PER_BATCH)
    query.awaitTermination()
    return store.read("last_seen").select("user_id", "event_type", "ts")


QUERIES = {"stream_scd1_merge": merge_from_files}

ORACLE = {
    "stream_scd1_merge": """
        SELECT user_id, event_type, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
}
