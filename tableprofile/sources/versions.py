"""Results as a table of versions: a reader sees one version, whatever is published meanwhile.

    data/commit=<id>/job_id=<job>/name=<name>   rows, written once and never changed
    manifests/<id>                              the parts that make a version, as Parquet
    versions/<number>                           the id of the manifest, published by a rename

A version exists once its small file does. The file is written aside and renamed, which fails
if the number is taken; the change is then made again on the newer version. The rename is as
atomic as that of the file system (HDFS: fully; local folders check the name first; object
stores without a rename need their own committer).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile import defaults
from tableprofile.functions.joins import join_few
from tableprofile.functions.tidy import TIDY_SCHEMA
from tableprofile.sources.results import RESULT_SCHEMA, retained_results

_PARTS = "commit string, job_id string, name string, created_at timestamp"
_KEYS = ["commit", "job_id", "name"]
_DIGITS = 12


class _Folder:
    """A folder of small files, through the Hadoop file system of its URI."""

    def __init__(self, spark: SparkSession, uri: str) -> None:
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._gateway = spark.sparkContext._gateway
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString
        path, settings = self._path(uri), spark.sparkContext._jsc.hadoopConfiguration()
        self._uri = uri
        self._files = path.getFileSystem(settings)
        self._context = self._hadoop.FileContext.getFileContext(path.toUri(), settings)

    def _path(self, uri: str):
        return self._hadoop.Path(uri)

    def names(self) -> list[str]:
        if not self._files.exists(self._path(self._uri)):
            return []
        return [f.getPath().getName() for f in self._files.listStatus(self._path(self._uri))]

    def text(self, name: str) -> str:
        stream = self._files.open(self._path(f"{self._uri}/{name}"))
        try:
            return self._read(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Publish a whole file at once; False if the name is taken."""
        aside = self._path(f"{self._uri}/_{uuid.uuid4().hex}")
        stream = self._files.create(aside, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        kind = getattr(self._hadoop.Options, "Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            self._context.rename(aside, self._path(f"{self._uri}/{name}"), options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False
        return True


def published_versions(spark: SparkSession, uri: str) -> list[int]:
    """The numbers of all versions, in order."""
    return sorted(int(n) for n in _Folder(spark, f"{uri}/versions").names() if n.isdigit())


def latest_version(spark: SparkSession, uri: str) -> int | None:
    """The number of the newest version; None where nothing is published."""
    return max(published_versions(spark, uri), default=None)


def _name(version: int) -> str:
    return f"{version:0{_DIGITS}d}"


def _parts(spark: SparkSession, uri: str, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], _PARTS)
    manifest = _Folder(spark, f"{uri}/versions").text(_name(version))
    return spark.read.schema(_PARTS).parquet(f"{uri}/manifests/{manifest}")


def _publish(spark: SparkSession, uri: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """Publish what ``change`` makes of the parts of the newest version."""
    folder = _Folder(spark, f"{uri}/versions")
    while True:
        newest = latest_version(spark, uri)
        manifest = uuid.uuid4().hex
        change(_parts(spark, uri, newest)).write.parquet(f"{uri}/manifests/{manifest}")
        number = (newest or 0) + 1
        if folder.create(_name(number), manifest):
            return number


def _stored(spark: SparkSession, uri: str, commits: list[str]) -> DataFrame:
    schema = T.StructType([*RESULT_SCHEMA.fields[:-2], *[T.StructField(c, T.StringType()) for c in _KEYS]])
    if not commits:
        return spark.createDataFrame([], schema)
    paths = [f"{uri}/data/commit={c}" for c in commits]
    return spark.read.schema(schema).option("basePath", f"{uri}/data").parquet(*paths)


def publish_results(
    results: DataFrame, uri: str, job_id: str, name: str = "results", created_at: datetime | None = None
) -> int:
    """Publish a version with these tidy results in place of those of the same job and name.

    Without rows, the version holds nothing of that job and name. Returns its number.
    """
    if not job_id or not name:
        raise ValueError("job_id and name must not be empty")
    spark, commit = results.sparkSession, uuid.uuid4().hex
    created = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    results.select(
        *TIDY_SCHEMA.names, created.alias("created_at"),
        F.lit(job_id).alias("job_id"), F.lit(name).alias("name"),
    ).write.partitionBy("job_id", "name").parquet(f"{uri}/data/commit={commit}")
    added = _stored(spark, uri, [commit]).groupBy(*_KEYS).agg(F.max("created_at").alias("created_at"))
    same = (F.col("job_id") == job_id) & (F.col("name") == name)
    return _publish(spark, uri, lambda parts: parts.where(~same).unionByName(added))


def read_version(
    spark: SparkSession,
    uri: str,
    version: int | None = None,
    job_id: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """The results of a version (the newest by default), of one job or all.

    The frame stays on its version whatever is published later. A version that was never
    published is an error; where there is none at all, the newest is empty.
    """
    if version is None:
        version = latest_version(spark, uri)
    elif version not in published_versions(spark, uri):
        raise ValueError(f"No version {version} in {uri}")
    wanted = [F.col(c) == v for c, v in (("job_id", job_id), ("name", name)) if v is not None]
    parts = reduce(DataFrame.where, wanted, _parts(spark, uri, version))
    # Folders of one write each, whose number follows the jobs and not their rows.
    commits = [row["commit"] for row in parts.select("commit").distinct().collect()]
    rows = reduce(DataFrame.where, wanted, _stored(spark, uri, sorted(commits)))
    return join_few(rows, parts.select(*_KEYS), _KEYS, "left_semi").select(*RESULT_SCHEMA.names)


def publish_retained(
    spark: SparkSession,
    uri: str,
    days: int = defaults.RETENTION_DAYS,
    as_of: datetime | Column | None = None,
) -> int:
    """Publish a version without the jobs whose latest result is older than ``days`` days.

    Only the list of parts is written; rows are neither read nor moved, and earlier versions
    can still be read.
    """
    return _publish(spark, uri, lambda parts: retained_results(parts, days, as_of))
