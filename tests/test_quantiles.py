from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import tableprofile as tp
from tableprofile.operators import quantiles


def lower_median(values):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[(len(kept) + 1) // 2 - 1] if kept else None


CASES = {
    "odd": [3.0, 1.0, 2.0],
    "even": [4.0, 1.0, 3.0, 2.0],
    "one": [7.0],
    "two halves": [1.0] * 50 + [2.0] * 50,
    "infinite": [-math.inf, 1.0, math.inf, math.inf],
    "all infinite": [math.inf, -math.inf],
    "missing": [None, math.nan, 5.0, None, 1.0, 9.0],
    "empty": [],
    "only missing": [None, math.nan],
    "tiny": [5e-324, 0.0, 1e-323, -5e-324],
    "zeros": [0.0, -0.0, 0.0, 1.0],
}


@pytest.mark.parametrize("name", CASES)
def test_exact_median(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert tp.exact_median(df, "v") == lower_median(values)


@pytest.mark.parametrize("accuracy", [2, 10, 100])
def test_exact_median_with_coarse_sketches(spark, monkeypatch, accuracy):
    """Coarse sketches miss the middle and need many rounds; the result is exact."""
    monkeypatch.setattr(quantiles, "_ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "_MARGIN", 0.4 / accuracy)
    rng = random.Random(accuracy)
    values = [math.exp(rng.gauss(0, 5)) for _ in range(500)] + [1.0] * rng.randrange(400)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    assert tp.exact_median(df, "v") == lower_median(values)


def test_median_of_large_column(spark):
    df = spark.range(100_001).select(((F.col("id") * 7919) % 100_001).alias("v"))
    assert tp.exact_median(df, "v") == 50_000.0
    assert abs(tp.approx_median(df, "v") - 50_000) <= 1_001


def test_whole_numbers_keep_their_digits(spark):
    large = 9007199254740993
    df = spark.createDataFrame([(large,)] * 3 + [(large + 2,)] * 2, "v long")
    assert tp.exact_median(df, "v") == large
    odd = spark.createDataFrame([(large + i,) for i in range(11)], "v long")
    assert tp.exact_median(odd, "v") == large + 5
    exact = df.select((F.col("v").cast("decimal(30,2)") + F.expr("0.01BD")).alias("v"))
    assert tp.exact_median(exact, "v") == Decimal("9007199254740993.01")


def test_approximate_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert tp.approx_median(df, "v") is None


def test_exact_quantiles_of_extreme_numbers(spark):
    """Huge ranges, infinities, least doubles, ties, NULL, NaN and an empty column."""
    inf, nan = float("inf"), float("nan")
    a = [1.7e308, -1.7e308, 5e-324, 1e-323, 0.0, 2.0, 2.0, 2.0, 3.5, -1e-200]
    b = [inf, -inf, nan, None, 1.0, 1.0, -inf, 7.0, 1e300, 5e-324]
    df = spark.createDataFrame(
        [(x, y, None) for x, y in zip(a, b)], "a double, b double, c double")
    shares = [0, 0.25, 0.5, 0.75, 1.0]
    found = quantiles.exact_quantiles(df.repartition(3), ["a", "b", "c"], shares)
    for name, values in (("a", a), ("b", [x for x in b if x is not None and x == x])):
        ordered = sorted(values)
        want = [ordered[max(1, math.ceil(s * len(ordered))) - 1] for s in shares]
        assert found[name] == want
    assert found["c"] == []
    assert quantiles.exact_quantiles(df, [], shares) == {}
