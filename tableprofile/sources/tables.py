"""Tables in and out: CSV, JSON, text and Parquet at any URI Spark can reach."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_FORMATS = {".csv": "csv", ".json": "json", ".txt": "text", ".parquet": "parquet"}
# Object stores by provider and the URI scheme Spark reads them with.
_SCHEMES = {"s3": "s3a", "gcs": "gs", "azure": "abfss"}


def table_format(uri: str) -> str:
    """The format a file or folder name stands for, by its lower-cased extension."""
    extension = posixpath.splitext(uri.rstrip("/"))[1].lower()
    if extension not in _FORMATS:
        raise ValueError(f"Unsupported file type: {extension}")
    return _FORMATS[extension]


def load_table(
    spark: SparkSession,
    uri: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    **options: str | bool | float,
) -> DataFrame:
    """Read a table; the format follows the extension unless given.

    CSV has a header and its types are inferred, as JSON's are. Inference reads
    the data once more, so pass ``schema`` for large inputs.
    """
    fmt = fmt or table_format(uri)
    if fmt not in _FORMATS.values():
        raise ValueError(f"Unsupported file type: {fmt}")
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.csv(
            uri,
            header=options.get("header", True),
            inferSchema=options.get("inferSchema", schema is None),
            multiLine=multi_line,
        )
    if fmt == "json":
        df = reader.json(uri, multiLine=multi_line)
        if df.columns == ["_corrupt_record"]:
            raise ValueError(f"No JSON record per line in {uri}; try multi_line=True")
        return df
    return reader.text(uri) if fmt == "text" else reader.parquet(uri)


def save_table(
    df: DataFrame,
    uri: str,
    fmt: str | None = None,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    **options: str | bool,
) -> str:
    """Write a table, one file per partition; the format follows the extension."""
    fmt = fmt or table_format(uri)
    if fmt not in _FORMATS.values():
        raise ValueError(f"Unsupported file type: {fmt}")
    if fmt == "csv":
        options.setdefault("header", True)
    df.write.format(fmt).mode(mode).options(**options).partitionBy(*partition_by).save(uri)
    return uri


def object_uri(provider: str, container: str, path: str, account: str | None = None) -> str:
    """URI of an object-store path; credentials stay in the cluster's settings."""
    if provider not in _SCHEMES:
        raise ValueError(f"Unsupported provider: {provider}")
    if provider == "azure":
        if account is None:
            raise ValueError("azure needs the storage account")
        container = f"{container}@{account}.dfs.core.windows.net"
    return f"{_SCHEMES[provider]}://{container}/{path.lstrip('/')}"


def copy_table(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType | str | None = None,
    mode: str = "errorifexists",
) -> str:
    """Upload or download: read one URI and write another, in parallel."""
    return save_table(load_table(spark, source, schema=schema), target, mode=mode)
