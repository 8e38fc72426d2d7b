"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE decides broadcasts, coalescing and skew splits from measured sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Lists per key are gathered by hash up to this many keys per task, by sorting beyond.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` is for local runs only."""
    builder = SparkSession.builder.appName("shelfweave")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession, fallback: str) -> str:
    """The shared folder the cluster names for checkpoints, or ``fallback`` where none is set."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback
