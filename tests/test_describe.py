from __future__ import annotations

import math
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tableprofile as tp
from tableprofile.operators import describe, measures


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def by_first(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture
def nulls(spark):
    data = [(1.0, 2.0), (2.0, None), (None, 5.0), (4.0, 1.0), (5.0, 9.0)]
    return spark.createDataFrame(data, "a double, b double")


def test_empty_table_gives_zero_percent(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert by_first(tp.missing_values(df)) == {"a": (0, 0.0), "b": (0, 0.0)}
    assert tuple(tp.missing_overall(df).first()) == (0, 0, 0.0)
    assert by_first(tp.unique_values(df)) == {"a": (0, 0.0), "b": (0, 0.0)}
    assert by_first(tp.unique_values(df, approx=True)) == {"a": (0, 0.0), "b": (0, 0.0)}
    assert by_first(tp.summary_statistics(df)) == {"a": (None, None, None, None)}
    assert tp.basic_info(df).first()["size_bytes"] == 0
    assert tp.value_counts(df, "b").count() == 0


def test_deviation_of_one_row_is_null(spark):
    df = spark.createDataFrame([(3.0,)], "a double")
    assert by_first(tp.summary_statistics(df)) == {"a": (3.0, 3.0, 3.0, None)}


def test_null_is_a_distinct_value_and_nan_is_not_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,), (math.nan,)], "a double")
    assert by_first(tp.unique_values(df)) == {"a": (3, 75.0)}
    assert by_first(tp.unique_values(df, approx=True)) == {"a": (3, 75.0)}
    assert by_first(tp.missing_values(df)) == {"a": (1, 25.0)}


def test_zero_and_minus_zero_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "a double")
    assert by_first(tp.unique_values(df)) == {"a": (1, 50.0)}


def test_correlation_of_pairs_and_of_zero_filled(spark, nulls):
    x, y = [1.0, 4.0, 5.0], [2.0, 1.0, 9.0]
    assert tp.correlation(nulls).first()["correlation"] == round(pearson(x, y), 4)
    x, y = [1.0, 2.0, 0.0, 4.0, 5.0], [2.0, 0.0, 5.0, 1.0, 9.0]
    found = tp.correlation(nulls, nulls="zero").first()["correlation"]
    assert found == round(pearson(x, y), 4)
    with pytest.raises(ValueError):
        tp.correlation(nulls, nulls="drop")


def pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    return cov / math.sqrt(sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y))


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert [r["correlation"] for r in tp.correlation(df).collect()] == [None]


def test_correlation_equals_the_built_in_one(spark):
    df = spark.range(200).select(
        *[F.when(F.col("id") % (i + 2) > 0, (F.col("id") * (i + 3)) % 17).alias(f"c{i}") for i in range(6)],
        F.lit(None).cast("double").alias("nothing"),
    )
    found = by_first(tp.correlation(df, digits=None))
    assert len(found) == 21
    for pair, (value,) in found.items():
        x, y = pair.split(" vs ")
        both = df.filter(f"{x} is not null and {y} is not null")
        built_in = both.agg(F.corr(x, y)).first()[0] if "nothing" not in pair else None
        assert value is None if built_in is None else value == pytest.approx(built_in, abs=1e-9)


def test_correlation_by_sums_equals_that_by_matrices(spark, monkeypatch):
    rng = random.Random(3)
    odd = [None, float("nan"), float("inf")]
    rows = [
        tuple(
            rng.choice(odd) if k == 1 and rng.random() < 0.01 else
            None if k in (2, 3) and rng.random() < 0.2 else rng.gauss(k * 1e6, 1 + k) + len(str(k))
            for k in range(6)
        )
        for _ in range(500)
    ]
    df = spark.createDataFrame(rows, ", ".join(f"c{k} double" for k in range(6))).repartition(3)
    for chosen in (None, ["c0", "c4"], ["c2", "c3", "c5"]):
        by_sums = tp.correlation(df, columns=chosen, digits=8).collect()
        with monkeypatch.context() as patch:
            patch.setattr("tableprofile.operators.describe._SCANS", 0)
            assert str(tp.correlation(df, columns=chosen, digits=8).collect()) == str(by_sums)


def test_correlation_of_large_values_keeps_its_digits(spark):
    df = spark.range(100).select(
        (F.col("id") % 7 + 1e12).alias("a"), (F.col("id") % 5 + 1e12).alias("b")
    )
    near = spark.range(100).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"))
    assert tp.correlation(df).first() == tp.correlation(near).first()


def test_non_finite_values_spoil_their_own_pairs_only(spark):
    rows_ = [(1.0, 2.0, 3.0), (2.0, 4.0, math.nan), (3.0, 6.0, None), (4.0, 8.0, math.inf)]
    found = by_first(tp.correlation(spark.createDataFrame(rows_, "a double, b double, c double")))
    assert found["a vs b"] == (1.0,)
    assert math.isnan(found["a vs c"][0]) and math.isnan(found["b vs c"][0])


def test_tables_without_numbers_give_messages(spark):
    df = spark.createDataFrame([("x", True, date(2024, 1, 1))], "a string, b boolean, c date")
    assert tp.summary_statistics(df).count() == 0
    assert tp.correlation(df).count() == 0
    found = tp.profile(df, ["summary_stats", "correlation"])
    assert rows(found, "section", "metric", "str_value") == [
        ("correlation", "message", "Need at least 2 numeric columns for correlation"),
        ("summary_stats", "message", "No numeric columns found in dataset"),
    ]
    info = tp.basic_info(df).first()
    assert (info["numeric_columns"], info["other_columns"], info["size_bytes"]) == (0, 3, 6)
    assert info["data_types"] == {"a": "string", "b": "boolean", "c": "date"}


def test_decimals_are_numeric(spark):
    df = spark.createDataFrame([(Decimal("1.50"),), (None,), (Decimal("2.50"),)], "a decimal(5,2)")
    assert by_first(tp.summary_statistics(df))["a"][:3] == (1.5, 2.5, 2.0)
    assert by_first(tp.unique_values(df)) == {"a": (3, 100.0)}


def test_nested_types_are_measured_and_counted(spark):
    df = spark.sql(
        """select array('ab', 'c', null) as names, map('k', 1) as m,
                  named_struct('x', 1L, 'y', 'four') as s, cast('xyz' as binary) as b
           union all select null, null, null, null"""
    )
    # 3 + (1 + 4) + (8 + 4) + 3 bytes, and the long of the NULL struct.
    assert tp.basic_info(df).first()["size_bytes"] == 3 + 5 + 12 + 3 + 8
    assert by_first(tp.unique_values(df)) == {c: (2, 100.0) for c in df.columns}
    assert by_first(tp.missing_values(df)) == {c: (1, 50.0) for c in df.columns}


def test_column_names_with_dots_and_quotes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0)], ["a.b", "c`d"])
    assert [r["column"] for r in tp.summary_statistics(df).collect()] == ["a.b", "c`d"]
    assert by_first(tp.unique_values(df)) == {"a.b": (2, 100.0), "c`d": (2, 100.0)}
    assert tp.correlation(df).first()["pair"] == "a.b vs c`d"
    assert tp.value_counts(df, "a.b").count() == 2
    assert tp.profile(df, tp.STATISTICS, value_count_columns=["a.b"]).count() > 0


def test_ties_are_ordered_by_value_with_null_first(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("None",)], "c string")
    found = [(r["value"], r["count"]) for r in tp.value_counts(df, "c", top_n=3).collect()]
    assert found == [(None, 1), ("None", 1), ("a", 1)]
    assert tp.value_counts(df, "c", top_n=None).count() == 4
    with pytest.raises(ValueError):
        tp.value_counts(df, "absent")


def test_wide_table_is_split_into_scans(spark):
    df = spark.range(10).select(
        *[F.when(F.col("id") >= i % 10, F.col("id") + i).alias(f"c{i}") for i in range(130)]
    )
    assert by_first(tp.missing_values(df)) == {f"c{i}": (i % 10, i % 10 * 10.0) for i in range(130)}
    overall = tp.missing_overall(df).first()
    assert (overall["total_missing"], overall["total_cells"]) == (13 * 45, 1300)
    summary = by_first(tp.summary_statistics(df, max_cols=None))
    assert len(summary) == 130
    assert summary["c12"][:2] == (14.0, 21.0)
    several = [describe.summary_measures(df, max_cols=None), describe.missing_measures(df)]
    scans = measures._scans(several)
    assert sum(len(s.cells) for s in scans) == 130 + 131
    widths = [sum(a.fields for a in s.aggregates.values()) for s in scans]
    assert sum(w > measures.MAX_STATE_FIELDS for w in widths) <= 1  # the total over all columns


def test_every_column_counts(spark):
    df = spark.range(3).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(15)])
    assert tp.summary_statistics(df).count() == 15
    assert tp.correlation(df).count() == 105
    assert tp.correlation(df.limit(0)).count() == 105
    assert tp.summary_statistics(df, max_cols=10).count() == 10
    assert tp.correlation(df, max_cols=5).count() == 10


def test_names_under_both_parser_settings(spark):
    df = spark.createDataFrame([(1, 2)], ["it's", "b\\c"])
    for setting in ("true", "false"):
        spark.conf.set("spark.sql.parser.escapedStringLiterals", setting)
        try:
            found = {r["column"] for r in tp.missing_values(df).collect()}
        finally:
            spark.conf.unset("spark.sql.parser.escapedStringLiterals")
        assert found == {"it's", "b\\c"}


def test_long_texts_are_counted_by_digest(spark):
    texts = ["x" * 40, "x" * 40, "x" * 41, "x" * 31, None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert by_first(tp.unique_values(df))["t"][0] == 5


def test_statistics_do_not_depend_on_partitions(spark, nulls):
    for n in (1, 3):
        df = nulls.repartition(n)
        assert rows(tp.unique_values(df), "column", "unique_count") == [("a", 5), ("b", 5)]
        assert tp.correlation(df).first() == tp.correlation(nulls).first()


def test_hot_value_is_counted_whole(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k")
    )
    assert by_first(tp.unique_values(df)) == {"k": (20_001, 66.67)}
    first = tp.value_counts(df, "k", 1).first()
    assert (first["value"], first["count"]) == (-1, 10_000)


def test_statistics_keep_code_generation(spark):
    df = spark.range(10).select(*[F.rand(i).alias(f"c{i}") for i in range(10)])
    for found in (tp.summary_statistics(df), tp.missing_values(df)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        aggregates = [line for line in plan.splitlines() if "HashAggregate" in line]
        assert aggregates
    assert all(
        sum(a.fields for a in scan.aggregates.values()) <= measures.MAX_STATE_FIELDS
        for scan in measures._scans([describe.summary_measures(df)])
    )
