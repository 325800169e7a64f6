"""Results of jobs as one partitioned table, its inventory and its retention."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile import defaults
from tableprofile.functions.joins import join_few
from tableprofile.functions.tidy import TIDY_SCHEMA
from tableprofile.operators.scaling import run_summary

RESULT_SCHEMA = T.StructType(
    [
        *TIDY_SCHEMA.fields,
        T.StructField("created_at", T.TimestampType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)


def save_results(
    results: DataFrame,
    uri: str,
    job_id: str,
    name: str = "results",
    created_at: datetime | None = None,
    fmt: str = "parquet",
) -> str:
    """Store tidy results under their job; saving the same name again replaces them."""
    created = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    rows = results.select(
        *TIDY_SCHEMA.names,
        created.alias("created_at"),
        F.lit(job_id).alias("job_id"),
        F.lit(name).alias("name"),
    )
    writer = rows.write.format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("job_id", "name").save(uri)
    return uri


def load_results(
    spark: SparkSession,
    uri: str,
    job_id: str | None = None,
    name: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Stored results, of one job or all; empty where nothing is stored.

    Job and name are partition columns, so only their folders are read.
    """
    try:
        stored = spark.read.format(fmt).schema(RESULT_SCHEMA).load(uri)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RESULT_SCHEMA)
    for column, value in (("job_id", job_id), ("name", name)):
        if value is not None:
            stored = stored.filter(F.col(column) == value)
    return stored


def save_run_metrics(runs: DataFrame, uri: str, fmt: str = "json", mode: str = "overwrite") -> str:
    """Store the runs and their summary side by side."""
    runs.write.format(fmt).mode(mode).save(f"{uri}/metrics")
    run_summary(runs).write.format(fmt).mode(mode).save(f"{uri}/summary")
    return uri


def stored_files(spark: SparkSession, uri: str) -> DataFrame:
    """Every file below ``uri`` with its job folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(uri)
        .select("path", "length", "modificationTime")
    )
    base = urlparse(uri).path.rstrip("/")
    # Drops the scheme and authority of the listed path, then the base folder.
    inside = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    relative = F.substring(inside, len(base) + 2, 2**31 - 1)
    folders = F.split(relative, "/")
    job = F.when(F.size(folders) > 1, folders[0])
    return files.select(job.alias("job_dir"), "path", "length", "modificationTime")


def storage_inventory(
    spark: SparkSession, uri: str, digits: int | None = defaults.PERCENT_DIGITS
) -> DataFrame:
    """Total size, files and jobs below the results folder.

    Files directly in the folder belong to no job and are not counted.
    """
    files = stored_files(spark, uri).filter(F.col("job_dir").isNotNull())
    size = F.coalesce(F.sum("length"), F.lit(0).cast("long"))
    megabytes = size / F.lit(1024.0 * 1024.0)
    return files.agg(
        size.alias("total_bytes"),
        (megabytes if digits is None else F.round(megabytes, digits)).alias("total_size_mb"),
        F.count(F.lit(1)).alias("file_count"),
        F.countDistinct("job_dir").alias("job_count"),
    )


def rewrite_retained(
    spark: SparkSession,
    uri: str,
    target: str,
    days: int = defaults.RETENTION_DAYS,
    as_of: datetime | Column | None = None,
    fmt: str = "parquet",
) -> str:
    """Write the results that are not expired to a new table beside the stored one.

    Nothing is deleted; readers move to the new table when it is complete.
    """
    kept = retained_results(load_results(spark, uri, fmt=fmt), days, as_of)
    kept.write.format(fmt).mode("errorifexists").partitionBy("job_id", "name").save(target)
    return target


def _cutoff(as_of: datetime | Column | None, days: int) -> Column:
    now = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return now - F.make_dt_interval(F.lit(days))


def expired_jobs(
    results: DataFrame,
    days: int = defaults.RETENTION_DAYS,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Jobs whose latest result is older than ``days`` days."""
    latest = results.groupBy("job_id").agg(F.max("created_at").alias("last_created"))
    return latest.filter(F.col("last_created") < _cutoff(as_of, days))


def retained_results(
    results: DataFrame,
    days: int = defaults.RETENTION_DAYS,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Results of the jobs that are not expired, to be written to a new table.

    The rows of a job are spread over the join by a salt.
    """
    expired = expired_jobs(results, days, as_of).select("job_id")
    return join_few(results, expired, ["job_id"], "left_anti")
