"""Session settings the operators are designed for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# The row-returning joins keep hot keys apart through AQE's skew split, so it must stay on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster use the one spark-submit gives."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("carelens")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CARELENS_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
