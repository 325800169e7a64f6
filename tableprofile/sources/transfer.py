"""Files of any kind copied byte for byte between file systems, in parallel and checked."""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tableprofile.functions.checkpoints import cut_lineage

_BLOCK = 8 * 2**20
# Spark's names of schemes that the Arrow file systems call otherwise.
_SCHEMES = {"s3a://": "s3://", "s3n://": "s3://"}


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (or absolute path) and the path in it."""
    for spark, arrow in _SCHEMES.items():
        if uri.startswith(spark):
            uri = arrow + uri.removeprefix(spark)
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    files, path = fs.FileSystem.from_uri(uri)
    return files, path.rstrip("/")


def _below(files: fs.FileSystem, root: str) -> list[tuple[str, int]]:
    """Relative path and length of the files of a folder, or ('', length) of a file."""
    info = files.get_file_info(root)
    if info.type == fs.FileType.File:
        return [("", info.size)]
    selector = fs.FileSelector(root, allow_not_found=True, recursive=True)
    found = [f for f in files.get_file_info(selector) if f.type == fs.FileType.File]
    return sorted((posixpath.relpath(f.path, root), f.size) for f in found)


def _joined(root: str, relative: str) -> str:
    return f"{root}/{relative}" if relative else root


def _digest(files: fs.FileSystem, path: str) -> tuple[int, str]:
    digest, length = hashlib.sha256(), 0
    with files.open_input_stream(path) as stream:
        while block := stream.read(_BLOCK):
            digest.update(block)
            length += len(block)
    return length, digest.hexdigest()


def _copied(files: fs.FileSystem, path: str, others: fs.FileSystem, target: str) -> tuple[int, str]:
    """Copy a file by blocks under a name of this attempt, compare it, give it its name.

    A task that is run again writes the same file again, so a lost executor leaves at most a
    file that begins with a dot.
    """
    context = TaskContext.get()
    attempt = 0 if context is None else context.taskAttemptId()
    folder, name = posixpath.split(target)
    aside = f"{folder}/.{name}.{attempt}.part"
    others.create_dir(folder, recursive=True)
    digest, length = hashlib.sha256(), 0
    with files.open_input_stream(path) as stream, others.open_output_stream(aside) as out:
        while block := stream.read(_BLOCK):
            digest.update(block)
            out.write(block)
            length += len(block)
    if _digest(others, aside) != (length, digest.hexdigest()):
        raise OSError(f"The copy of {path} differs from it")
    others.move(aside, target)
    return length, digest.hexdigest()


def transfer_files(
    spark: SparkSession, source: str, target: str, overwrite: bool = False
) -> DataFrame:
    """Copy a file, or all files below a folder, to ``target``; upload or download.

    Contents are not parsed, hidden and empty files are copied too, empty folders are not.
    A file is copied by blocks in one task, whatever its length, and read again at the target
    to compare SHA-256. Returns the copied files: relative path ('' if the source is a file),
    length and sha256. An absent source, or without ``overwrite`` a target that holds files,
    is an error. URIs are those Arrow can open: local paths, ``file``, ``s3`` and ``s3a``,
    ``gs``, ``abfss`` and, with its client installed, ``hdfs``; credentials are taken from the
    environment of the executors. Names of files are listed on the driver.
    """
    schema = "path string, length bigint, sha256 string"
    files, root = _opened(source)
    if files.get_file_info(root).type == fs.FileType.NotFound:
        raise FileNotFoundError(source)
    others, place = _opened(target)
    if not overwrite and _below_or_none(others, place):
        raise FileExistsError(target)
    listed = _below(files, root)
    if not listed:
        return spark.createDataFrame([], schema)

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, base = _opened(source)
        there, to = _opened(target)
        for batch in batches:
            rows = [
                (path, *_copied(here, _joined(base, path), there, _joined(to, path)))
                for path in batch["path"]]
            yield pd.DataFrame(rows, columns=["path", "length", "sha256"])

    # Dealt in turn over more tasks than cores, so that long files meet short ones.
    tasks = min(len(listed), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame(listed, "path string, length bigint").repartition(tasks)
    return cut_lineage(rows.mapInPandas(copy, schema))


def _below_or_none(files: fs.FileSystem, root: str) -> bool:
    if files.get_file_info(root).type == fs.FileType.NotFound:
        return False
    return bool(_below(files, root))
