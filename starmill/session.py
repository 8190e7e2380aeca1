"""Session settings the loads are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot orders, customers or products are split at join time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast is chosen from file sizes; two columns of a large dimension still fit.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the settings above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
