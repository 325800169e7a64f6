"""The folder shared by all executors, for cut lineage and scratch tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a fresh one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tableprofile-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once and read them from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of what is no longer referred to.

    It drops them (and checkpoints, where ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set) when the driver's JVM collects its garbage, which a loop of large rounds may not
    bring about for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
