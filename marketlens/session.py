"""Session settings for cluster and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "marketlens", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session tuned for large scans.

    Partition counts are left to AQE: shuffles start wide and are coalesced to
    the advisory size, skewed join partitions are split. Deep result pages stop
    using an in-memory top-k above the fallback threshold and sort instead.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "256m")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.sql.execution.topKSortFallbackThreshold", "1000000")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
