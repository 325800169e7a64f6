from __future__ import annotations

import pytest

import tableprofile as tp
from tableprofile.functions.tidy import TIDY_SCHEMA


@pytest.fixture(scope="module")
def table(spark):
    rows = [(float(i % 9), float(i), "ab"[i % 2], i % 3) for i in range(90)]
    return spark.createDataFrame(rows, "y double, x double, s string, k int")


def test_unknown_names_are_errors(table):
    with pytest.raises(ValueError, match="Unknown statistics type: median"):
        tp.profile(table, ["basic_info", "median"])
    with pytest.raises(ValueError, match="Unknown ML job type: forest"):
        tp.run_model(table, "forest")


def test_profile_equals_the_typed_operators(table):
    found = {
        (r["section"], r["subject"], r["metric"]): r["num_value"]
        for r in tp.profile(table, tp.STATISTICS).collect()
    }
    for r in tp.summary_statistics(table).collect():
        assert found["summary_stats", r["column"], "mean"] == r["mean"]
    for r in tp.missing_values(table).collect():
        assert found["missing_values", r["column"], "missing_count"] == r["missing_count"]
    for r in tp.unique_values(table).collect():
        assert found["unique_values", r["column"], "unique_pct"] == r["unique_pct"]
    for r in tp.correlation(table).collect():
        assert found["correlation", r["pair"], "correlation"] == r["correlation"]
    assert found["basic_info", None, "num_rows"] == 90


def test_profile_of_nothing_is_empty(table):
    found = tp.profile(table, [])
    assert found.schema == TIDY_SCHEMA and found.count() == 0


@pytest.mark.parametrize("job", list(tp.MODEL_JOBS))
def test_each_job_has_a_tidy_result(table, job):
    found = tp.run_model(table, job)
    assert found.columns == TIDY_SCHEMA.names
    assert {r["section"] for r in found.select("section").collect()} == {job}


def test_parts_that_cannot_run_become_error_rows(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    found = tp.analyze(df, ["basic_info", "mode"], [*tp.MODEL_JOBS, "forest"])
    errors = {r["section"]: r["str_value"] for r in found.filter("metric = 'error'").collect()}
    assert set(errors) == {"mode", "linear_regression", "kmeans", "decision_tree", "forest"}
    assert found.filter("section = 'fpgrowth'").count() > 0
    assert found.filter("section = 'basic_info'").count() > 0


def test_an_unknown_value_count_column_is_an_error_row(table):
    found = tp.analyze(table, ["basic_info", "value_counts"], [],
                       stat_params={"value_count_columns": ["absent"]})
    errors = {r["section"]: r["str_value"] for r in found.filter("metric = 'error'").collect()}
    assert errors == {"value_counts": "Unknown columns: absent"}
    assert found.filter("section = 'basic_info'").count() > 0


def test_value_counts_without_columns_says_so(table):
    assert tp.profile(table, ["value_counts"]).first()["metric"] == "message"


def test_parameters_reach_the_jobs(table):
    found = tp.analyze(table, [], ["kmeans"], model_params={"kmeans": {"k": 2}})
    clusters = found.filter("metric = 'clusters'").first()["num_value"]
    assert clusters == 2
    assert tp.analyze(table, [], []).count() == 0


def test_result_can_be_stored_and_read_back(spark, table, tmp_path):
    uri = str(tmp_path / "results")
    found = tp.analyze(table, models=["fpgrowth"])
    tp.save_results(found, uri, "job-1")
    stored = tp.load_results(spark, uri, "job-1")
    assert stored.count() == found.count()


def test_runs_add_a_scaling_section(spark, table):
    runs = spark.createDataFrame(
        [("j", n, 8.0 / n) for n in (1, 2, 4)], "job string, workers int, execution_time double")
    found = tp.analyze(table, [], [], runs=runs).filter("metric = 'scalability_type'").first()
    assert found["section"] == "scalability" and found["str_value"].startswith("Excellent")
