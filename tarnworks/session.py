"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates are cut from timestamps in the session zone, so every job uses one zone.
# Sorts and aggregates hold a task's rows, and Parquet and shuffles pack some 20 times as many bytes of rows as they take on
# disk. At Spark's 128 MB and 64 MB a task would need gigabytes; the work is the same, in more tasks.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app_name: str = "tarnworks", settings: dict[str, str] | None = None) -> SparkSession:
    """Build or fetch a session; the master and cluster sizes come from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
