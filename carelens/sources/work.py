"""Cutting lineage: what a step has computed is written to the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder spark.checkpoint.dir names. Only a local session without one gets a temporary one."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    there = "file://" + tempfile.mkdtemp(prefix="carelens-")
    spark.conf.set("spark.checkpoint.dir", there)
    return there


def cut(df: DataFrame) -> DataFrame:
    """df, computed and written to the shared folder now; what reads it computes nothing again.

    Files go with the DataFrame where spark.cleaner.referenceTracking.cleanCheckpoints is on.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
