"""Session settings that fit the amount of data."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quarryline.runtime import SHUFFLE_PARTITION_BYTES


def recommended_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Spark settings for a job over so many bytes on so many cores.

    Shuffles start with partitions of about 128 MB, which adaptive execution merges when
    they turn out small and splits in joins when keys are skewed.
    """
    partitions = max(cores, input_bytes // SHUFFLE_PARTITION_BYTES)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m" if input_bytes > 1 << 40 else "128m",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_settings(builder: SparkSession.Builder, input_bytes: int, cores: int) -> SparkSession.Builder:
    for key, value in recommended_settings(input_bytes, cores).items():
        builder = builder.config(key, value)
    return builder
