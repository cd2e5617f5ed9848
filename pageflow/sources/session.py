"""Session with the settings the jobs rely on; sizing of executors belongs to spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pageflow.functions.fixed_values import MAX_RECORDS_PER_FILE, SCAN_SPLIT_BYTES

SETTINGS = {
    "spark.sql.files.maxPartitionBytes": SCAN_SPLIT_BYTES,
    "spark.sql.files.maxRecordsPerFile": str(MAX_RECORDS_PER_FILE),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that a window left in order need no hashing (or sorting again) to be aggregated.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
}


def create_spark(app_name: str = "pageflow", **settings: str) -> SparkSession:
    """Session with adaptive execution; the number of shuffle partitions stays as the cluster or caller set it."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
