"""How jobs scale with workers, from a table of runs (job, workers, execution_time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile import defaults
from tableprofile.functions.columns import clamp, named, rounded
from tableprofile.functions.joins import join_few

SUMMARY_DIGITS = 2


def speedup(runs: DataFrame) -> DataFrame:
    """Speedup ``T1/Tn`` and efficiency ``speedup/n`` in percent of every run.

    The baseline of a job is the mean time of its one-worker runs, whichever
    order the runs were recorded in. Without one the run is its own baseline and
    ``has_baseline`` is false. A run without a time never finished: it has neither.
    The runs of a job are spread over the join by a salt.
    """
    baseline = (
        runs.filter(F.col("workers") == defaults.BASELINE_WORKERS)
        .groupBy("job")
        .agg(F.avg("execution_time").alias("baseline_time"))
    )
    joined = join_few(runs, baseline, ["job"], "left")
    time, workers = F.col("execution_time"), F.col("workers")
    base = F.coalesce(F.col("baseline_time"), time)
    ratio = (
        F.when(time.isNull(), F.lit(None).cast("double"))
        .when(workers == defaults.BASELINE_WORKERS, 1.0)
        .when(time > 0, F.try_divide(base, time))
        .otherwise(1.0)
    )
    extra = [named(c) for c in runs.columns if c not in ("job", "workers", "execution_time")]
    return joined.select(
        "job",
        "workers",
        "execution_time",
        *extra,
        base.alias("baseline_time"),
        F.col("baseline_time").isNotNull().alias("has_baseline"),
        ratio.alias("speedup"),
        (F.try_divide(ratio, workers) * 100.0).alias("efficiency"),
    )


def performance_by_workers(measured: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean time, speedup and efficiency per worker count, fewest workers first."""
    means = [F.avg(c).alias(c) for c in ("execution_time", "speedup", "efficiency")]
    return measured.groupBy(*by, "workers").agg(*means).orderBy(*by, "workers")


def run_summary(runs: DataFrame, digits: int | None = SUMMARY_DIGITS) -> DataFrame:
    """Number, total, mean, shortest and longest time of the completed runs."""
    time = F.col("execution_time")
    done = F.count(time)
    return runs.agg(
        done.alias("total_jobs"),
        rounded(F.sum(time), digits).alias("total_time"),
        rounded(F.avg(time), digits).alias("average_time"),
        rounded(F.min(time), digits).alias("min_time"),
        rounded(F.max(time), digits).alias("max_time"),
        F.when(F.count(F.lit(1)) == 0, F.lit(defaults.NO_METRICS))
        .when(done == 0, F.lit(defaults.NO_COMPLETED_JOBS))
        .alias("message"),
    )


def scalability(
    measured: DataFrame, by: Sequence[str] = ("job",), digits: int | None = SUMMARY_DIGITS
) -> DataFrame:
    """Scalability class, best speedup and Amdahl estimate per job.

    The parallel portion inverts Amdahl's law at the largest worker count,
    ``p = (1 - 1/S) / (1 - 1/n)``, clamped to [0, 1]; the ceiling ``1/(1-p)`` is
    NULL, with ``unlimited`` set, when p is 1. Runs without a speedup are left out;
    fewer than two others give only a message. Pass ``by=()`` to judge all rows together.
    """
    finished = F.col("speedup").isNotNull()
    largest = F.max(F.when(finished, F.struct("workers", "speedup")))
    facts = measured.groupBy(*by).agg(
        F.count("speedup").alias("n"),
        F.max("speedup").alias("best"),
        F.avg("efficiency").alias("mean_efficiency"),
        largest.alias("largest"),
    )
    enough = F.col("n") >= 2
    portion = _parallel_portion(F.col("largest.speedup"), F.col("largest.workers"))
    facts = facts.withColumn("portion", portion)
    unlimited = F.col("portion") >= 1.0
    ceiling = F.when(~unlimited, F.try_divide(F.lit(1.0), 1.0 - F.col("portion")))
    names, advice = _classes(F.col("mean_efficiency"))
    columns = {
        "scalability_type": names,
        "max_speedup_achieved": rounded(F.col("best"), digits),
        "average_efficiency": rounded(F.col("mean_efficiency"), digits),
        "estimated_parallel_portion": rounded(F.col("portion") * 100.0, digits),
        "theoretical_max_speedup": rounded(ceiling, digits),
        "unlimited": unlimited,
        "recommendation": advice,
    }
    return facts.select(
        *by,
        *[F.when(enough, e).alias(name) for name, e in columns.items()],
        F.when(~enough, F.lit(defaults.INSUFFICIENT_RUNS)).alias("message"),
    )


def scalability_detail(measured: DataFrame, by: Sequence[str] = ("job",)) -> DataFrame:
    """The means of each worker count beside the class of its job."""
    judged = scalability(measured, by).drop("message", "recommendation")
    means = performance_by_workers(measured, by)
    if not by:
        return means.withColumn("one", F.lit(1)).join(
            judged.withColumn("one", F.lit(1)), "one").drop("one")
    return join_few(means, judged, list(by), "left")


def _parallel_portion(best: Column, workers: Column) -> Column:
    saved = 1.0 - F.try_divide(F.lit(1.0), best)
    possible = 1.0 - F.try_divide(F.lit(1.0), workers)
    portion = F.try_divide(saved, possible)
    return F.when(portion.isNotNull(), clamp(portion, 0.0, 1.0))


def _classes(efficiency: Column) -> tuple[Column, Column]:
    names = advice = None
    for least, name, recommendation in reversed(defaults.SCALABILITY_CLASSES):
        if least is None:
            names, advice = F.lit(name), F.lit(recommendation)
            continue
        names = F.when(efficiency >= least, name).otherwise(names)
        advice = F.when(efficiency >= least, recommendation).otherwise(advice)
    known = efficiency.isNotNull()
    return F.when(known, names), F.when(known, advice)
