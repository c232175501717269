"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Safe on any cluster: AQE sizes the partitions after each shuffle and splits
# skewed join and rebalance partitions, so nothing here depends on data size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; intermediate tables go to a folder of its own.

    ``spark.checkpoint.dir`` names another one.
    """
    settings.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lodestar-"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lodestar")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
