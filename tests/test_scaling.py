from __future__ import annotations

import pytest

import tableprofile as tp

SCHEMA = "job string, workers int, execution_time double"


def runs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_speedup_does_not_depend_on_the_order_of_runs(spark):
    rows = [("j", 4, 5.0), ("j", 2, 6.0), ("j", 1, 10.0), ("j", 8, 0.0), ("k", 2, None)]
    found = {(r["job"], r["workers"]): r for r in tp.speedup(runs(spark, rows)).collect()}
    assert found["j", 4]["speedup"] == 2.0 and found["j", 4]["efficiency"] == 50.0
    assert found["j", 1]["speedup"] == 1.0 and found["j", 1]["efficiency"] == 100.0
    assert found["j", 8]["speedup"] == 1.0 and found["j", 8]["efficiency"] == 12.5
    assert found["j", 2]["baseline_time"] == 10.0 and found["j", 2]["has_baseline"]
    assert found["k", 2]["speedup"] is None


def test_unfinished_runs_are_no_perfect_ones(spark):
    measured = tp.speedup(runs(spark, [("j", 1, None), ("j", 2, 5.0)]))
    found = {r["workers"]: r for r in measured.collect()}
    assert found[1]["speedup"] is None and found[1]["efficiency"] is None
    assert tp.scalability(measured).first()["message"] is not None


def test_hot_jobs_are_salted(spark):
    plan = tp.speedup(runs(spark, [("j", 1, 1.0)]))._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "__tp_salt" in join


def test_job_without_baseline_is_its_own(spark):
    found = tp.speedup(runs(spark, [("j", 2, 5.0), ("j", 4, 3.0)])).collect()
    assert {(r["speedup"], r["has_baseline"]) for r in found} == {(1.0, False)}
    assert {r["efficiency"] for r in found} == {50.0, 25.0}


def scaled(spark, time):
    measured = tp.speedup(runs(spark, [("j", n, time(n)) for n in (1, 2, 4, 8)]))
    return tp.scalability(measured).first()


def test_perfect_scaling_is_unlimited(spark):
    found = scaled(spark, lambda n: 8.0 / n)
    assert found["scalability_type"].startswith("Excellent")
    assert found["estimated_parallel_portion"] == 100.0
    assert found["unlimited"] and found["theoretical_max_speedup"] is None
    assert (found["max_speedup_achieved"], found["average_efficiency"]) == (8.0, 100.0)


def test_flat_scaling_has_no_parallel_portion(spark):
    found = scaled(spark, lambda n: 8.0)
    assert found["scalability_type"].startswith("Poor")
    assert found["estimated_parallel_portion"] == 0.0
    assert found["theoretical_max_speedup"] == 1.0 and not found["unlimited"]


@pytest.mark.parametrize("portion", [0.5, 0.9])
def test_amdahl_estimate_inverts_the_law(spark, portion):
    found = scaled(spark, lambda n: (1 - portion) + portion / n)
    assert found["estimated_parallel_portion"] == pytest.approx(portion * 100)
    assert found["theoretical_max_speedup"] == pytest.approx(1 / (1 - portion))


@pytest.mark.parametrize(
    ("efficiency", "name"), [(85.0, "Excellent"), (84.9, "Good"), (70.0, "Good"), (50.0, "Fair"), (49.9, "Poor")]
)
def test_class_limits(spark, efficiency, name):
    measured = spark.createDataFrame(
        [(2, 1.5, efficiency), (4, 1.5, efficiency)],
        "workers int, speedup double, efficiency double",
    )
    assert tp.scalability(measured, by=()).first()["scalability_type"].startswith(name)


def test_one_run_is_not_enough(spark):
    found = tp.scalability(tp.speedup(runs(spark, [("j", 1, 1.0)]))).first()
    assert found["message"] == "Insufficient data for scalability analysis"
    assert found["scalability_type"] is None


def test_summary_counts_completed_runs_only(spark):
    found = tp.run_summary(runs(spark, [("j", 1, 1.0), ("j", 2, None), ("k", 1, 2.0)])).first()
    assert tuple(found) == (2, 3.0, 1.5, 1.0, 2.0, None)
    assert tp.run_summary(runs(spark, [("j", 1, None)])).first()["message"] == "No completed jobs"


def test_means_per_worker_count_are_ordered(spark):
    measured = tp.speedup(runs(spark, [("j", 2, 5.0), ("j", 1, 10.0), ("k", 2, 10.0), ("k", 1, 10.0)]))
    found = [tuple(r) for r in tp.performance_by_workers(measured).collect()]
    assert found == [(1, 10.0, 1.0, 100.0), (2, 7.5, 1.5, 75.0)]


def test_detail_holds_the_class_of_each_job(spark):
    measured = tp.speedup(runs(spark, [("j", n, 8.0 / n) for n in (1, 2, 4)]))
    found = tp.scalability_detail(measured).orderBy("workers").collect()
    assert [r["workers"] for r in found] == [1, 2, 4]
    assert {r["scalability_type"][:9] for r in found} == {"Excellent"}
    together = tp.scalability_detail(measured, by=()).collect()
    assert len(together) == 3


def test_no_runs_at_all(spark):
    assert tp.run_summary(runs(spark, [])).first()["message"] == "No metrics collected"
