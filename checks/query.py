"""What a registered query is, and the pieces the query modules share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Float sums differ between engines in the last bits; round them at output."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def percent_sql(part: str, total: str) -> str:
    """Percentage to two places, half up, in whole numbers until the last step."""
    return f"((20000 * ({part}) + ({total})) // (2 * ({total}))) / 100e0"


def union_sql(branches: list[str]) -> str:
    return "\nunion all\n".join(branches)


# Test tables have no NULLs, so some values are read as NULL on both sides.
LINEITEM_NULLS = {
    "l_tax": 0.0,
    "l_discount": 0.05,
    "l_linenumber": 3,
    "l_returnflag": "N",
}


def lineitem_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "lineitem")
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in LINEITEM_NULLS.items()})


def _nullif_sql(column: str, value: float | str) -> str:
    literal = f"'{value}'" if isinstance(value, str) else f"{value}"
    return f"nullif({column}, {literal}) as {column}"


LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

LINEITEM_NULLS_SQL = "select {} from lineitem".format(
    ", ".join(
        _nullif_sql(c, LINEITEM_NULLS[c]) if c in LINEITEM_NULLS else c for c in LINEITEM_COLUMNS
    )
)


def md5_train_sql(key: str, seed: int = 42, threshold: int = 800) -> str:
    """The portable split rule: md5 of key and seed, first 32 bits, mod 1000."""
    digest = f"md5(cast({key} as varchar) || '|{seed}')"
    return f"(('0x' || substr({digest}, 1, 8))::bigint % 1000 < {threshold})"
