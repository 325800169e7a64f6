"""Queries for sources, sinks, the result store and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableprofile as tp
from checks.query import Query, table
from checks.scaling import runs
from tableprofile.functions.checkpoints import scratch_path

_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _csv_with_schema(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    path = tp.save_table(orders, scratch_path(spark, "orders") + ".csv")
    return tp.load_table(spark, path, schema=orders.schema)


def _csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "customer") + ".CSV"
    tp.save_table(table(spark, folder, "customer"), path)
    return tp.load_table(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def _json(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    path = scratch_path(spark, "events") + ".json"
    tp.save_table(events, path, timestampNTZFormat=_MICROS)
    return tp.load_table(spark, path, schema=events.schema, timestampNTZFormat=_MICROS)


def _json_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "part") + ".json"
    tp.save_table(table(spark, folder, "part"), path)
    found = tp.load_table(spark, path)
    return found.withColumn("p_size", F.col("p_size").cast("int"))


def _text(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "documents") + ".txt"
    tp.save_table(table(spark, folder, "documents").select("text"), path)
    lines = tp.load_table(spark, path)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("copies"))


def _copy(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "supplier") + ".parquet"
    tp.copy_table(spark, f"{folder}/supplier.parquet", target)
    return tp.load_table(spark, target)


def _store(spark: SparkSession, folder: str) -> str:
    """Two jobs' results; the first is saved twice and must not double."""
    uri = scratch_path(spark, "results")
    orders, events = table(spark, folder, "orders"), table(spark, folder, "events")
    stats = ["value_counts"]
    first = tp.profile(orders, stats, value_count_columns=["o_orderpriority"])
    second = tp.profile(events, stats, value_count_columns=["event_type"])
    when = datetime(2024, 1, 1)
    for results, job in ((first, "orders"), (first, "orders"), (second, "events")):
        tp.save_results(results, uri, job, created_at=when)
    return uri


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    found = tp.load_results(spark, _store(spark, folder), "orders")
    return found.drop("created_at", "name")


def _stored_all(spark: SparkSession, folder: str) -> DataFrame:
    found = tp.load_results(spark, _store(spark, folder))
    return found.drop("created_at", "name")


def _counts_sql(job: str, name: str, column: str, columns: str) -> str:
    return f"""select {columns} from (
  select 'value_counts' as section, '{column}' as subject, 'count' as metric,
         cast(count(*) as double) as num_value, {column} as str_value, '{job}' as job_id
  from {name} group by {column} order by count(*) desc, {column} limit 10)"""


def _inventory(spark: SparkSession, folder: str) -> DataFrame:
    """One folder per market segment, one line per customer name."""
    uri = scratch_path(spark, "segments")
    named = table(spark, folder, "customer").select("c_mktsegment", "c_name")
    # One file for each segment.
    dealt = named.repartition(5, "c_mktsegment")
    tp.save_table(dealt, uri, fmt="text", partition_by=["c_mktsegment"])
    found = tp.storage_inventory(spark, uri)
    return found.select(
        "total_bytes",
        "total_size_mb",
        F.col("file_count").cast("long").alias("file_count"),
        "job_count",
    )


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    uri = scratch_path(spark, "metrics")
    tp.save_run_metrics(runs(spark, folder), uri)
    summary = spark.read.json(f"{uri}/summary")
    back = spark.read.json(f"{uri}/metrics").agg(F.count(F.lit(1)).alias("stored_runs"))
    stored = back.select(F.lit("metrics").alias("part"), F.col("stored_runs").cast("double").alias("value"))
    names = ("total_jobs", "total_time", "average_time", "min_time", "max_time")
    cells = [F.struct(F.lit(n).alias("part"), F.col(n).cast("double").alias("value")) for n in names]
    return stored.unionByName(summary.select(F.inline(F.array(*cells))))


# Each user is a job; an event is a result the user's job left behind.
RESULTS_SQL = """select 'user ' || cast(user_id as varchar) as job_id, ts as created_at, event_id
from events"""
CUTOFF_SQL = "(select max(ts) from events) - interval {days} day"


def _event_results(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("job_id"),
        F.col("ts").alias("created_at"),
        "event_id",
    )


def _latest(spark: SparkSession, folder: str):
    newest = table(spark, folder, "events").agg(F.max("ts")).first()[0]
    return F.lit(newest.isoformat()).cast("timestamp_ntz")


def _rewritten(spark: SparkSession, folder: str) -> DataFrame:
    """One job is stored long ago, one on the day; the new table holds the second."""
    uri, target = scratch_path(spark, "results"), scratch_path(spark, "kept")
    for name, column, when in (
        ("orders", "o_orderpriority", datetime(2024, 1, 1)),
        ("events", "event_type", datetime(2024, 1, 20)),
    ):
        found = tp.profile(table(spark, folder, name), ["value_counts"], value_count_columns=[column])
        tp.save_results(found, uri, name, created_at=when)
    tp.rewrite_retained(spark, uri, target, days=7, as_of=datetime(2024, 1, 21))
    return tp.load_results(spark, target).drop("created_at", "name")


def _transferred(spark: SparkSession, folder: str) -> DataFrame:
    """A table of several files, copied as files and read from the copy."""
    source, target = (scratch_path(spark, n) for n in ("files", "copies"))
    table(spark, folder, "customer").repartition(4, "c_custkey").write.partitionBy("c_mktsegment").parquet(source)
    tp.transfer_files(spark, source, target)
    return spark.read.parquet(target)


def _published(spark: SparkSession, folder: str) -> tuple[str, int]:
    """Two jobs published, one of them twice, then retention; the version before it is returned."""
    uri = scratch_path(spark, "versions")
    for name, column, when in (
        ("orders", "o_orderstatus", datetime(2024, 1, 1)),
        ("orders", "o_orderpriority", datetime(2024, 1, 2)),
        ("events", "event_type", datetime(2024, 1, 20)),
    ):
        found = tp.profile(table(spark, folder, name), ["value_counts"], value_count_columns=[column])
        before = tp.publish_results(found, uri, name, created_at=when)
    tp.publish_retained(spark, uri, days=7, as_of=datetime(2024, 1, 21))
    return uri, before


def _pinned_version(spark: SparkSession, folder: str) -> DataFrame:
    return tp.read_version(spark, *_published(spark, folder)).drop("created_at", "name")


def _retained_version(spark: SparkSession, folder: str) -> DataFrame:
    return tp.read_version(spark, _published(spark, folder)[0]).drop("created_at", "name")


_RESULT_COLUMNS = "section, subject, metric, num_value, str_value, job_id"
_EVENT_COUNTS_SQL = _counts_sql("events", "events", "event_type", _RESULT_COLUMNS)
_ORDER_COUNTS_SQL = _counts_sql("orders", "orders", "o_orderpriority", _RESULT_COLUMNS)

QUERIES = {
    "transferred_files": Query(_transferred, "select * from customer"),
    "version_pinned_before_retention": Query(
        _pinned_version, f"{_ORDER_COUNTS_SQL}\nunion all\n{_EVENT_COUNTS_SQL}"
    ),
    "version_after_retention": Query(_retained_version, _EVENT_COUNTS_SQL),
    "rewritten_results": Query(
        _rewritten,
        _counts_sql(
            "events", "events", "event_type",
            "section, subject, metric, num_value, str_value, job_id",
        ),
    ),
    "csv_scan_with_schema": Query(_csv_with_schema, "select * from orders"),
    "csv_scan_inferred": Query(_csv_inferred, "select * from customer"),
    "json_scan_with_schema": Query(_json, "select * from events"),
    "json_scan_inferred": Query(_json_inferred, "select * from part"),
    "text_scan_lines": Query(
        _text,
        """select value, count(*) as copies
from (select unnest(string_split(text, chr(10))) as value from documents) group by value""",
    ),
    "parquet_scan": Query(
        lambda s, d: tp.load_table(s, f"{d}/part.parquet"), "select * from part"
    ),
    "copy_table": Query(_copy, "select * from supplier"),
    "results_of_one_job": Query(
        _stored,
        _counts_sql(
            "orders",
            "orders",
            "o_orderpriority",
            "section, subject, metric, num_value, str_value, job_id",
        ),
    ),
    "results_of_all_jobs": Query(
        _stored_all,
        _counts_sql(
            "orders", "orders", "o_orderpriority",
            "section, subject, metric, num_value, str_value, job_id",
        )
        + "\nunion all\n"
        + _counts_sql(
            "events", "events", "event_type",
            "section, subject, metric, num_value, str_value, job_id",
        ),
    ),
    "storage_inventory": Query(
        _inventory,
        """select cast(sum(strlen(c_name) + 1) as bigint) as total_bytes,
       round(cast(sum(strlen(c_name) + 1) as double) / 1048576e0, 2) as total_size_mb,
       count(distinct c_mktsegment) as file_count,
       count(distinct c_mktsegment) as job_count from customer""",
    ),
    "run_metrics_sink": Query(
        _metrics,
        """select 'metrics' as part, cast(count(*) as double) as value from events
union all select 'total_jobs', cast(count(value) as double) from events
union all select 'total_time', round(sum(value), 2) from events
union all select 'average_time', round(avg(value), 2) from events
union all select 'min_time', round(min(value), 2) from events
union all select 'max_time', round(max(value), 2) from events""",
    ),
    "expired_jobs": Query(
        lambda s, d: tp.expired_jobs(_event_results(s, d), days=1, as_of=_latest(s, d)),
        f"""select job_id, max(created_at) as last_created from ({RESULTS_SQL}) group by job_id
having max(created_at) < {CUTOFF_SQL.format(days=1)}""",
    ),
    "retained_results": Query(
        lambda s, d: tp.retained_results(_event_results(s, d), days=1, as_of=_latest(s, d)),
        f"""select job_id, created_at, event_id from ({RESULTS_SQL})
where job_id in (select job_id from ({RESULTS_SQL}) group by job_id
                 having max(created_at) >= {CUTOFF_SQL.format(days=1)})""",
    ),
}
