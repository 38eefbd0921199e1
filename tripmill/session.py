"""A session with the options the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tripmill", master: str | None = None, **options: str) -> SparkSession:
    """Create (or reuse) a session; ``options`` override the values set here.

    Shuffle partitions are left to the cluster: AQE coalesces small ones and splits
    skewed ones, both in joins and in the rebalance before each partitioned write.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        # Call sites in error messages double the time it takes to build a plan in Python.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    for key, value in {**defaults, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
