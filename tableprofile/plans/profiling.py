"""Several statistics of one table as a single tidy result."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile import defaults
from tableprofile.functions.tidy import melt
from tableprofile.operators.describe import (
    approx_unique_measures,
    basic_info_measures,
    correlation,
    correlation_columns,
    missing_measures,
    summary_measures,
    unique_values,
    value_counts,
)
from tableprofile.operators.measures import Measures, measure_tidy

STATISTICS = (
    "basic_info",
    "summary_stats",
    "missing_values",
    "unique_values",
    "correlation",
    "value_counts",
)


def profile(
    df: DataFrame,
    stats: Sequence[str] = STATISTICS[:4],
    approx_unique: bool = False,
    value_count_columns: Sequence[str] = (),
    top_n: int = defaults.TOP_VALUES,
    max_summary_cols: int | None = defaults.SUMMARY_COLUMNS,
    max_correlation_cols: int | None = defaults.CORRELATION_COLUMNS,
) -> DataFrame:
    """The chosen statistics in tidy form.

    Statistics with small state share scans of the table. Exact unique values,
    correlations and value counts are computed apart.
    """
    unknown = [s for s in stats if s not in STATISTICS]
    if unknown:
        raise ValueError(f"Unknown statistics type: {', '.join(unknown)}")
    shared, apart = [], []
    for stat in dict.fromkeys(stats):
        if stat == "basic_info":
            shared.append(basic_info_measures(df))
        elif stat == "summary_stats":
            shared.append(summary_measures(df, max_cols=max_summary_cols))
        elif stat == "missing_values":
            shared.append(missing_measures(df))
        elif stat == "unique_values" and approx_unique:
            shared.append(approx_unique_measures(df))
        elif stat == "unique_values":
            unique = unique_values(df)
            apart.append(melt(unique, stat, F.col("column"), ["unique_count", "unique_pct"]))
        elif stat == "correlation":
            if len(correlation_columns(df, None, max_correlation_cols)) < 2:
                message = defaults.TWO_COLUMNS_FOR_CORRELATION
                shared.append(Measures(stat, {}, (), message=message))
            else:
                found = correlation(df, max_cols=max_correlation_cols)
                apart.append(melt(found, stat, F.col("pair"), ["correlation"]))
        elif not value_count_columns:
            shared.append(Measures(stat, {}, (), message=defaults.NO_VALUE_COUNT_COLUMNS))
        else:
            apart += [_value_count_rows(df, column, top_n) for column in value_count_columns]
    parts = ([measure_tidy(df, shared)] if shared else []) + apart
    if not parts:
        return measure_tidy(df, [])
    return reduce(DataFrame.unionByName, parts)


def _value_count_rows(df: DataFrame, column: str, top_n: int) -> DataFrame:
    """One row per value: the value as text, its count as the number."""
    counted = value_counts(df, column, top_n)
    return counted.select(
        F.lit("value_counts").alias("section"),
        F.lit(column).alias("subject"),
        F.lit("count").alias("metric"),
        F.col("count").cast("double").alias("num_value"),
        F.col("value").cast("string").alias("str_value"),
    )
