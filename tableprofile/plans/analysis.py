"""A whole analysis: statistics, then modelling jobs, as one tidy result."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.tidy import melt, tidy_facts
from tableprofile.operators.scaling import scalability, speedup
from tableprofile.plans.jobs import MODEL_JOBS, run_model
from tableprofile.plans.profiling import STATISTICS, profile


def analyze(
    df: DataFrame,
    stats: Sequence[str] = STATISTICS[:4],
    models: Sequence[str] = tuple(MODEL_JOBS),
    stat_params: Mapping[str, Any] | None = None,
    model_params: Mapping[str, Mapping[str, Any]] | None = None,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Every chosen statistic and modelling job in one tidy result.

    A part that cannot run on this table becomes an ``error`` row and the rest
    goes on. ``runs`` (job, workers, execution_time) adds how the jobs scale. Persist ``df`` first when reading it again is dear (CSV, JSON).
    """
    spark = df.sparkSession
    known = [s for s in stats if s in STATISTICS]
    parts = _profiled(df, known, stat_params or {}) if known else []
    parts += [
        tidy_facts(spark, s, [(None, "error", f"Unknown statistics type: {s}")])
        for s in stats
        if s not in STATISTICS
    ]
    for job in models:
        params = (model_params or {}).get(job, {})
        parts.append(_or_error(df, job, lambda: run_model(df, job, **params)))
    if runs is not None:
        parts.append(_or_error(df, "scalability", lambda: _scaling(runs)))
    if not parts:
        return tidy_facts(spark, "analysis", [])
    return reduce(DataFrame.unionByName, parts)


def _scaling(runs: DataFrame) -> DataFrame:
    judged = scalability(speedup(runs))
    metrics = [c for c in judged.columns if c not in ("job", "unlimited")]
    return melt(judged, "scalability", F.col("job"), metrics)


def _profiled(
    df: DataFrame, stats: Sequence[str], params: Mapping[str, Any]
) -> list[DataFrame]:
    """All statistics in shared scans or, where one cannot run, each by itself."""
    try:
        return [profile(df, stats, **params)]
    except (ValueError, PySparkException):
        return [_or_error(df, s, lambda s=s: profile(df, [s], **params)) for s in stats]


def _or_error(df: DataFrame, section: str, run: Callable[[], DataFrame]) -> DataFrame:
    try:
        return run()
    except (ValueError, PySparkException, Py4JJavaError) as error:
        text = str(error).strip() or type(error).__name__
        return tidy_facts(df.sparkSession, section, [(None, "error", text)])
