"""Stored sketches of columns: distinct values and quantiles that grow by merging.

A state is a row for each group (say a day) and column. New data costs one scan of itself:
its states are stored beside the others, and any set of them is merged without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.columns import named, require_columns

# 2 ** 12 registers: a standard error of 1.04 / 64.
LG_REGISTERS = 12
# Normalised rank error below 0.0133 with 99 percent confidence.
KLL_SIZE = 200

DISTINCT_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2)
RANK_ERROR = 0.0133

_STATE = ("rows", "present", "distinct_state", "quantile_state")


def _hashable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def sketch_states(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per group and column: rows, present values, and the two sketches.

    Values enter the distinct sketch by a 64-bit hash, so any type but maps and variants has
    one. Numeric columns also have a quantile sketch of their values as doubles; NULL and NaN
    do not enter it. One scan for all columns; a task shuffles two sketches a column and group.
    The result has the columns of ``by``, then column, rows, present, distinct_state and
    quantile_state. Without ``by``, an empty table has one row of empty states a column.
    """
    require_columns(df, by)
    if columns is None:
        columns = [f.name for f in df.schema.fields if f.name not in by and _hashable(f.dataType)]
    require_columns(df, columns)
    clash = {"column", *_STATE} & set(by)
    if clash:
        raise ValueError(f"Names taken by the states: {', '.join(sorted(clash))}")
    aggregates, cells = [F.count(F.lit(1)).alias("rows")], []
    # Grouping columns stay apart from the aggregates, whatever their names.
    keys = [named(c).alias(f"by_{k}") for k, c in enumerate(by)]
    for k, name in enumerate(columns):
        value = named(name)
        hashed = F.when(value.isNotNull(), F.xxhash64(value))
        aggregates += [
            F.count(value).alias(f"present_{k}"),
            F.hll_sketch_agg(hashed, LG_REGISTERS).alias(f"distinct_{k}"),
        ]
        quantiles: Column = F.lit(None).cast("binary")
        if isinstance(df.schema[name].dataType, T.NumericType):
            aggregates.append(_numbers_sketch(value).alias(f"quantile_{k}"))
            quantiles = F.col(f"quantile_{k}")
        cells.append(F.struct(
            F.lit(name).alias("column"), F.col("rows"), F.col(f"present_{k}").alias("present"),
            F.col(f"distinct_{k}").alias("distinct_state"), quantiles.alias("quantile_state")))
    grouped = df.groupBy(*keys).agg(*aggregates)
    names = [F.col(f"by_{k}").alias(c) for k, c in enumerate(by)]
    if not cells:
        raise ValueError("No columns to sketch")
    return grouped.select(*names, F.inline(F.array(*cells)))


def _numbers_sketch(value: Column) -> Column:
    number = value.cast("double")
    return F.kll_sketch_agg_double(F.when(~F.isnan(number), number), KLL_SIZE)


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of coarser groups: those of all rows with the same ``by`` and column."""
    require_columns(states, [*by, "column", *_STATE])
    return states.groupBy(*[named(c) for c in by], "column").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"),
        F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.kll_merge_agg_double("quantile_state").alias("quantile_state"))


def state_estimates(states: DataFrame, ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """What states tell: rows, missing, distinct values (NULL is one) and values at ranks.

    The estimate of distinct values has a standard error of ``DISTINCT_ERROR``; the rank of a
    quantile is off by less than ``RANK_ERROR`` with 99 percent confidence. Columns that are
    not numeric, or hold no number, have no quantiles.
    """
    if any(not 0 <= r <= 1 for r in ranks):
        raise ValueError("ranks lie between 0 and 1")
    missing = F.col("rows") - F.col("present")
    some = F.col("quantile_state").isNotNull() & (F.kll_sketch_get_n_double("quantile_state") > 0)
    values = [
        F.when(some, F.kll_sketch_get_quantile_double("quantile_state", F.lit(float(r)))) for r in ranks]
    found = F.hll_sketch_estimate("distinct_state") + F.when(missing > 0, 1).otherwise(0)
    kept = [named(c) for c in states.columns if c not in _STATE]
    return states.select(
        *kept, "rows", missing.alias("missing"), found.alias("unique_estimate"),
        F.array(*values).cast("array<double>").alias("quantiles"))


def save_states(states: DataFrame, uri: str, by: Sequence[str]) -> str:
    """Store states by group; the groups given replace what is stored of them."""
    writer = states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*require_columns(states, by)).parquet(uri)
    return uri


def load_states(spark: SparkSession, uri: str, by: str | T.StructType) -> DataFrame | None:
    """Stored states, with the grouping columns of the schema ``by``; None if there are none."""
    fields = T.StructType.fromDDL(by) if isinstance(by, str) else by
    schema = T.StructType.fromDDL(
        "column string, rows bigint, present bigint, distinct_state binary, quantile_state binary")
    try:
        found = spark.read.schema(T.StructType([*schema.fields, *fields.fields])).parquet(uri)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.select(*fields.names, *schema.names)
