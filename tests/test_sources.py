from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import tableprofile as tp
from tableprofile.functions.checkpoints import shared_folder
from tableprofile.functions.tidy import TIDY_SCHEMA


def test_unknown_formats_and_providers(spark):
    for name in ("report.pdf", "noextension", "table.csv.gz"):
        with pytest.raises(ValueError, match="Unsupported file type"):
            tp.load_table(spark, name)
    with pytest.raises(ValueError, match="Unsupported file type"):
        tp.load_table(spark, "x", fmt="pdf")
    with pytest.raises(ValueError, match="Unsupported provider"):
        tp.object_uri("dropbox", "bucket", "x.csv")
    assert tp.object_uri("s3", "bucket", "/a/x.csv") == "s3a://bucket/a/x.csv"
    assert tp.object_uri("gcs", "bucket", "x.csv") == "gs://bucket/x.csv"
    azure = tp.object_uri("azure", "box", "x.csv", account="acc")
    assert azure == "abfss://box@acc.dfs.core.windows.net/x.csv"
    with pytest.raises(ValueError):
        tp.object_uri("azure", "box", "x.csv")


def test_csv_nulls_and_types(spark, tmp_path):
    path = tmp_path / "quirks.CSV"
    path.write_text('a,b,c\n1,,x\n2,"",NA\n3,NaN,y\n')
    df = tp.load_table(spark, str(path))
    assert [(r["a"], r["c"]) for r in df.collect()] == [(1, "x"), (2, "NA"), (3, "y")]
    found = [r["b"] for r in df.collect()]
    assert found[:2] == [None, None] and math.isnan(found[2])
    typed = tp.load_table(spark, str(path), schema="a bigint, b string, c string")
    assert typed.dtypes == [("a", "bigint"), ("b", "string"), ("c", "string")]


def test_json_array_over_several_lines(spark, tmp_path):
    path = tmp_path / "pretty.json"
    path.write_text('[\n {\n  "a": 1\n },\n {\n  "a": 2\n }\n]\n')
    with pytest.raises(ValueError, match="multi_line"):
        tp.load_table(spark, str(path))
    found = tp.load_table(spark, str(path), multi_line=True)
    assert sorted(r["a"] for r in found.collect()) == [1, 2]
    lines = tmp_path / "lines.json"
    lines.write_text('{"a": 1}\n{"a": 2}\n')
    assert tp.load_table(spark, str(lines)).count() == 2


def test_text_lines(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("one\n\ntwo\n")
    df = tp.load_table(spark, str(path))
    assert [r["value"] for r in df.collect()] == ["one", "", "two"]


def test_copy_between_formats_and_uris(spark, tmp_path):
    source, target = f"file://{tmp_path}/a.parquet", f"file://{tmp_path}/b.json"
    tp.save_table(spark.range(5), source)
    tp.copy_table(spark, source, target)
    assert tp.load_table(spark, target).count() == 5


def tidy(spark, value):
    return spark.createDataFrame([("s", None, "m", value, None)], TIDY_SCHEMA)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_results_are_stored_per_job_and_replaced(spark, tmp_path, fmt):
    uri = str(tmp_path / "results")
    assert tp.load_results(spark, uri, "a", fmt=fmt).count() == 0
    tp.save_results(tidy(spark, 1.0), uri, "a", fmt=fmt)
    tp.save_results(tidy(spark, 2.0), uri, "b", fmt=fmt)
    tp.save_results(tidy(spark, 3.0), uri, "a", fmt=fmt)
    tp.save_results(tidy(spark, 4.0), uri, "a", name="second", fmt=fmt)
    found = tp.load_results(spark, uri, "a", fmt=fmt)
    assert sorted(r["num_value"] for r in found.collect()) == [3.0, 4.0]
    assert tp.load_results(spark, uri, "a", "second", fmt=fmt).first()["num_value"] == 4.0
    assert tp.load_results(spark, uri, fmt=fmt).count() == 3
    assert tp.load_results(spark, uri, "absent", fmt=fmt).count() == 0
    assert "PartitionFilters: [isnotnull(job_id" in found._jdf.queryExecution().toString()


def test_inventory_counts_files_of_jobs_only(spark, tmp_path):
    base = tmp_path / "up loads"
    for job, name, size in (("a", "x.csv", 10), ("a", "deep/er/y.txt", 20), ("b", "z.json", 30)):
        path = base / job / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"." * size)
    (base / "loose.txt").write_bytes(b"ignored")
    for uri in (str(base), f"{base}/"):
        found = tp.storage_inventory(spark, uri).first()
        assert tuple(found) == (60, 0.0, 3, 2)


def test_jobs_expire_by_their_latest_result(spark):
    now = datetime(2024, 5, 20)
    ages = [("old", 8), ("old", 9), ("mixed", 30), ("mixed", 6), ("edge", 7)]
    df = spark.createDataFrame([(j, now - timedelta(days=d)) for j, d in ages], "job_id string, created_at timestamp")
    assert [r["job_id"] for r in tp.expired_jobs(df, as_of=now).collect()] == ["old"]
    kept = tp.retained_results(df, as_of=now)
    assert sorted(r["job_id"] for r in kept.collect()) == ["edge", "mixed", "mixed"]
    assert tp.expired_jobs(df, days=5, as_of=now).count() == 3
    assert tp.retained_results(df).count() == 0  # all older than a week by now


def test_run_metrics_sink(spark, tmp_path):
    uri = str(tmp_path / "metrics")
    df = spark.createDataFrame([("j", 1, 2.5)], "job string, workers int, execution_time double")
    tp.save_run_metrics(df, uri)
    assert spark.read.json(f"{uri}/summary").first()["total_time"] == 2.5
    assert spark.read.json(f"{uri}/metrics").count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") in shared_folder(spark)


def test_scan_reads_only_what_is_asked(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(10).select("id", F.lit("x").alias("s"), F.lit(1.0).alias("v")).write.parquet(path)
    df = tp.load_table(spark, path)
    plan = tp.summary_statistics(df, ["v"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<v:double>" in plan
    plan = tp.basic_info(df)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<s:string>" in plan


def test_retained_results_are_rewritten(spark, tmp_path):
    from datetime import datetime

    uri, target = str(tmp_path / "stored"), str(tmp_path / "kept")
    df = spark.createDataFrame([(1.0,)], "a double")
    for job, day in (("old", 1), ("new", 20)):
        tp.save_results(tp.profile(df), uri, job, created_at=datetime(2024, 1, day))
    tp.rewrite_retained(spark, uri, target, days=7, as_of=datetime(2024, 1, 21))
    assert {r["job_id"] for r in tp.load_results(spark, target).collect()} == {"new"}
    assert tp.load_results(spark, uri, "old").count() > 0
