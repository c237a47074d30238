"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks shuffle widths, splits skewed join partitions and turns a
# join into a broadcast only once the measured side is small enough.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """Create or reuse a session; sizes (memory, cores, shuffle width) stay with the deployment."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
