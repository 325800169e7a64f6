from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import tableprofile as tp
from tableprofile.operators.sketches import DISTINCT_ERROR, RANK_ERROR


def brute(rows, top_n):
    counts = {}
    for value in rows:
        counts[value] = counts.get(value, 0) + 1
    order = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0]))
    return [(None if v is None else str(v), n) for v, n in order[:top_n]]


def found(df, column):
    rows = df.where(F.col("column") == column).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    return [(r["value"], r["count"]) for r in rows]


@pytest.mark.parametrize("buckets", [1, 7, 16_384])
def test_top_values_equal_counting(spark, buckets):
    hot = [(1 if i % 3 == 0 else i, None if i % 5 == 0 else f"w{i % 40}", i) for i in range(2000)]
    df = spark.createDataFrame(hot, "a.b long, s string, key long".replace("a.b", "`a.b`"))
    top = tp.top_values(df.repartition(6), top_n=8, buckets=buckets)
    for k, column in enumerate(df.columns):
        assert found(top, column) == brute([r[k] for r in hot], 8)


def test_top_values_of_many_columns_in_groups(spark, monkeypatch):
    from tableprofile.operators import heavy

    monkeypatch.setattr(heavy, "_COUNTED", 32)
    df = spark.range(50).select(*[(F.col("id") % (k + 2)).alias(f"c{k}") for k in range(5)])
    top = tp.top_values(df, top_n=2, buckets=16)
    for k in range(5):
        assert found(top, f"c{k}") == brute([i % (k + 2) for i in range(50)], 2)


def test_top_values_of_odd_tables(spark):
    empty = spark.createDataFrame([], "a long, s string")
    assert tp.top_values(empty).count() == 0
    maps = spark.sql("select map(1, 2) as m, array(1) as a, cast('NaN' as double) as x, -0.0D as z")
    assert {r["column"] for r in tp.top_values(maps).collect()} == {"a", "x", "z"}
    assert tp.top_values(maps.select("m")).count() == 0
    with pytest.raises(ValueError, match="order"):
        tp.top_values(maps, ["m"])
    with pytest.raises(ValueError, match="Unknown"):
        tp.top_values(maps, ["absent"])
    with pytest.raises(ValueError):
        tp.top_values(maps, top_n=0)


def test_states_merge_to_what_one_scan_finds(spark):
    n = 20_000
    df = spark.range(n).select(
        (F.col("id") % 7).alias("day"), F.col("id").alias("key"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 300).cast("double").alias("x"),
        F.concat(F.lit("t"), (F.col("id") % 50).cast("string")).alias("t"))
    merged = tp.state_estimates(tp.merge_states(tp.sketch_states(df, ["day"])), (0.0, 0.5, 1.0))
    rows = {r["column"]: r for r in merged.collect()}
    assert set(rows) == {"key", "x", "t"}
    assert rows["x"]["missing"] == n // 4 and rows["t"]["missing"] == 0
    assert abs(rows["key"]["unique_estimate"] - n) <= 3 * DISTINCT_ERROR * n
    assert abs(rows["x"]["unique_estimate"] - 226) <= 3 * DISTINCT_ERROR * 226 + 1
    assert rows["t"]["quantiles"] == [None, None, None]
    low, middle, high = rows["key"]["quantiles"]
    assert (low, high) == (0.0, n - 1.0)
    assert abs(middle / n - 0.5) <= RANK_ERROR
    whole = {r["column"]: r for r in tp.state_estimates(tp.sketch_states(df.drop("day"))).collect()}
    assert whole["key"]["unique_estimate"] == rows["key"]["unique_estimate"]


def test_states_of_nothing_and_of_odd_numbers(spark):
    df = spark.createDataFrame([(None, math.nan), (None, None), (2.0, 1.0)], "`x.y` double, z double")
    rows = {r["column"]: r for r in tp.state_estimates(tp.sketch_states(df)).collect()}
    assert (rows["x.y"]["missing"], rows["x.y"]["unique_estimate"], rows["x.y"]["quantiles"]) == (2, 2, [2.0])
    assert (rows["z"]["missing"], rows["z"]["unique_estimate"], rows["z"]["quantiles"]) == (1, 3, [1.0])
    empty = tp.state_estimates(tp.merge_states(tp.sketch_states(df.limit(0)))).collect()
    assert {(r["column"], r["rows"], r["unique_estimate"], r["quantiles"][0]) for r in empty} == {
        ("x.y", 0, 0, None), ("z", 0, 0, None)}
    assert tp.sketch_states(df.withColumn("d", F.lit(1)).limit(0), ["d"]).count() == 0
    with pytest.raises(ValueError, match="taken"):
        tp.sketch_states(df.withColumn("rows", F.lit(1)), ["rows"])
    with pytest.raises(ValueError, match="between"):
        tp.state_estimates(tp.sketch_states(df), (2.0,))


def test_a_new_day_replaces_its_states_only(spark, tmp_path):
    uri = str(tmp_path / "states")
    assert tp.load_states(spark, uri, "day int") is None
    for day, rows in ((1, 10), (2, 20), (2, 30)):
        df = spark.range(rows).withColumn("day", F.lit(day))
        tp.save_states(tp.sketch_states(df, ["day"]), uri, ["day"])
    stored = tp.load_states(spark, uri, "day int")
    assert sorted((r["day"], r["rows"]) for r in stored.collect()) == [(1, 10), (2, 30)]
    assert tp.state_estimates(tp.merge_states(stored)).first()["unique_estimate"] == 30
