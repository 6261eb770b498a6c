"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Valid at any size: adaptive execution merges small shuffle partitions, splits skewed
# ones, and turns a join into a broadcast join once the real size of a side is known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configured(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Builder with the settings; give about two partitions per core of the cluster."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder
