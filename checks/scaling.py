"""Queries for the scaling analysis, on runs derived from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableprofile as tp
from checks.query import Query, rounded_doubles, table

# Every event is a run: its type is the job, its id picks the worker count.
RUNS_SQL = """select event_id, event_type as job,
       cast(case event_id % 4 when 0 then 1 when 1 then 2 when 2 then 4 else 8 end as integer)
         as workers,
       value as execution_time
from events"""
# Errors have no one-worker run.
NO_BASELINE_SQL = f"select * from ({RUNS_SQL}) where not (job = 'error' and workers = 1)"
MEAN_RUNS_SQL = f"""select job, workers, avg(execution_time) as execution_time
from ({RUNS_SQL}) group by job, workers"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.col("event_id") % 4
    workers = F.when(turn == 0, 1).when(turn == 1, 2).when(turn == 2, 4).otherwise(8)
    return table(spark, folder, "events").select(
        "event_id",
        F.col("event_type").alias("job"),
        workers.alias("workers"),
        F.col("value").alias("execution_time"),
    )


def no_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return runs(spark, folder).filter(~((F.col("job") == "error") & (F.col("workers") == 1)))


def mean_runs(spark: SparkSession, folder: str) -> DataFrame:
    return (
        runs(spark, folder)
        .groupBy("job", "workers")
        .agg(F.avg("execution_time").alias("execution_time"))
    )


def completed_or_not(spark: SparkSession, folder: str) -> DataFrame:
    return runs(spark, folder).withColumn(
        "execution_time", F.when(F.col("execution_time") <= 100, F.col("execution_time"))
    )


UNFINISHED_SQL = f"""select event_id, job, workers,
       case when execution_time <= 100 then execution_time end as execution_time
from ({RUNS_SQL})"""


def skewed(spark: SparkSession, folder: str) -> DataFrame:
    """Most runs are of one job."""
    return runs(spark, folder).withColumn(
        "job", F.when(F.col("event_id") % 10 > 0, "hot").otherwise(F.col("job"))
    )


SKEWED_SQL = f"""select event_id, workers, execution_time,
       case when event_id % 10 > 0 then 'hot' else job end as job from ({RUNS_SQL})"""


def speedup_sql(source: str, extra: str) -> str:
    """Unrounded speedup and efficiency of each run."""
    return f"""select r.job, r.workers, r.execution_time, {extra}
       coalesce(b.base, r.execution_time) as baseline_time, b.base is not null as has_baseline,
       case when r.execution_time is null then null
            when r.workers = 1 or r.execution_time <= 0 then 1e0
            else coalesce(b.base, r.execution_time) / r.execution_time end as speedup
from ({source}) r
left join (select job, avg(execution_time) as base from ({source})
           where workers = 1 group by job) b on b.job = r.job"""


def _speedup_rounded_sql(source: str) -> str:
    return f"""select event_id, job, workers, round(execution_time, 6) as execution_time,
       round(baseline_time, 6) as baseline_time, has_baseline, round(speedup, 6) as speedup,
       round(speedup / workers * 100, 6) as efficiency
from ({speedup_sql(source, "r.event_id,")})"""


MEASURED_SQL = f"""select *, speedup / workers * 100 as efficiency
from ({speedup_sql(MEAN_RUNS_SQL, "")})"""


def _scalability_sql(measured: str, by: str) -> str:
    columns, grouping = (f"{by},", f"group by {by}") if by else ("", "")
    return f"""with facts as (
  select {columns} count(*) as n, max(speedup) as best, avg(efficiency) as mean_efficiency,
         max(workers) as top
  from ({measured}) {grouping}
), at_top as (
  select f.*, (select max(m.speedup) from ({measured}) m
               where m.workers = f.top {f"and m.{by} = f.{by}" if by else ""}) as s
  from facts f
), portions as (
  select *, greatest(0, least(1, (1 - 1e0 / s) / (1 - 1e0 / top))) as p from at_top
)
select {columns}
  case when mean_efficiency >= 85 then 'Excellent (Near-linear scalability)'
       when mean_efficiency >= 70 then 'Good (Effective parallelization)'
       when mean_efficiency >= 50 then 'Fair (Moderate scalability)'
       else 'Poor (Limited benefits)' end as scalability_type,
  round(best, 2) as max_speedup_achieved,
  round(mean_efficiency, 2) as average_efficiency,
  round(p * 100, 2) as estimated_parallel_portion,
  case when p < 1 then round(1 / (1 - p), 2) end as theoretical_max_speedup,
  p >= 1 as unlimited,
  case when mean_efficiency >= 85 then
         'System scales very well. Consider adding more workers for larger datasets.'
       when mean_efficiency >= 70 then
         'Good scalability. Current configuration is efficient.'
       when mean_efficiency >= 50 then
         'Consider optimizing data partitioning or algorithm implementation.'
       else 'Parallelization overhead may be too high. Review algorithm and data size.'
       end as recommendation,
  cast(null as varchar) as message
from portions"""


# Times that shrink with the workers, so that the portions are not all zero.
def scaled_runs(spark: SparkSession, folder: str) -> DataFrame:
    faster = F.col("execution_time") / F.pow(F.col("workers").cast("double"), F.lit(0.75))
    return mean_runs(spark, folder).withColumn("execution_time", faster)


SCALED_SQL = f"""select job, workers, execution_time / power(workers::double, 0.75) as execution_time
from ({MEAN_RUNS_SQL})"""
SCALED_MEASURED_SQL = f"""select *, speedup / workers * 100 as efficiency
from ({speedup_sql(SCALED_SQL, "")})"""

QUERIES = {
    "speedup_runs": Query(
        lambda s, d: rounded_doubles(tp.speedup(runs(s, d))), _speedup_rounded_sql(RUNS_SQL)
    ),
    "speedup_no_baseline": Query(
        lambda s, d: rounded_doubles(tp.speedup(no_baseline(s, d))),
        _speedup_rounded_sql(NO_BASELINE_SQL),
    ),
    "speedup_unfinished": Query(
        lambda s, d: rounded_doubles(tp.speedup(completed_or_not(s, d))),
        _speedup_rounded_sql(UNFINISHED_SQL),
    ),
    "speedup_skewed": Query(
        lambda s, d: rounded_doubles(tp.speedup(skewed(s, d))), _speedup_rounded_sql(SKEWED_SQL)
    ),
    "scalability_unfinished": Query(
        lambda s, d: tp.scalability(tp.speedup(completed_or_not(s, d))),
        _scalability_sql(
            f"""select *, speedup / workers * 100 as efficiency
from ({speedup_sql(UNFINISHED_SQL, "")}) where execution_time is not null""",
            "job",
        ),
    ),
    "run_summary_of_nothing": Query(
        lambda s, d: tp.run_summary(runs(s, d).filter("workers < 0")).select("total_jobs", "message"),
        """select count(*) as total_jobs, 'No metrics collected' as message
from events where value is null""",
    ),
    "scalability_detail": Query(
        lambda s, d: rounded_doubles(
            tp.scalability_detail(tp.speedup(scaled_runs(s, d))).select(
                "job", "workers", "execution_time", "speedup", "efficiency", "scalability_type"
            )
        ),
        f"""with classes as ({_scalability_sql(SCALED_MEASURED_SQL, "job")})
select m.job, m.workers, round(m.execution_time, 6) as execution_time,
       round(m.speedup, 6) as speedup, round(m.efficiency, 6) as efficiency, c.scalability_type
from (select job, workers, avg(execution_time) as execution_time, avg(speedup) as speedup,
             avg(efficiency) as efficiency from ({SCALED_MEASURED_SQL}) group by job, workers) m
join classes c on c.job = m.job""",
    ),
    "performance_by_workers": Query(
        lambda s, d: rounded_doubles(tp.performance_by_workers(tp.speedup(mean_runs(s, d)))),
        f"""select workers, round(avg(execution_time), 6) as execution_time,
       round(avg(speedup), 6) as speedup, round(avg(efficiency), 6) as efficiency
from ({MEASURED_SQL}) group by workers order by workers""",
    ),
    "run_summary": Query(
        lambda s, d: tp.run_summary(completed_or_not(s, d)),
        """select count(*) as total_jobs, round(sum(value), 2) as total_time,
       round(avg(value), 2) as average_time, round(min(value), 2) as min_time,
       round(max(value), 2) as max_time, cast(null as varchar) as message
from events where value <= 100""",
    ),
    "scalability_per_job": Query(
        lambda s, d: tp.scalability(tp.speedup(mean_runs(s, d))),
        _scalability_sql(MEASURED_SQL, "job"),
    ),
    "scalability_scaled_per_job": Query(
        lambda s, d: tp.scalability(tp.speedup(scaled_runs(s, d))),
        _scalability_sql(SCALED_MEASURED_SQL, "job"),
    ),
    "scalability_overall": Query(
        lambda s, d: tp.scalability(
            tp.performance_by_workers(tp.speedup(scaled_runs(s, d))), by=()
        ),
        _scalability_sql(
            f"""select workers, avg(speedup) as speedup, avg(efficiency) as efficiency
from ({SCALED_MEASURED_SQL}) group by workers""",
            "",
        ),
    ),
}
