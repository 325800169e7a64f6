from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import tableprofile as tp
from tableprofile.operators.patterns import conditional_itemsets


def brute_force(table, columns, support):
    baskets = [
        {f"{c}_{v}" for c, v in zip(columns, row) if v is not None} for row in table
    ]
    baskets = [b for b in baskets if b]
    counts = Counter()
    for basket in baskets:
        for size in range(1, len(basket) + 1):
            counts.update(combinations(sorted(basket), size))
    least = math.ceil(support * len(baskets))
    return {items: n for items, n in counts.items() if n >= max(least, 1)}, len(baskets)


def collected(itemsets):
    found = [(tuple(sorted(r["items"])), r["freq"]) for r in itemsets.frame.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


@pytest.fixture(scope="module")
def table():
    rng = random.Random(5)
    pick = lambda values: rng.choice(values)
    rows = [(pick("xyz"), pick(["u", "v", None]), pick(["p", None])) for _ in range(300)]
    return rows + [(None, None, None)] * 40


@pytest.mark.parametrize("support", [0.3, 0.05, 0.005])
def test_itemsets_equal_brute_force(spark, table, support):
    df = spark.createDataFrame(table, "a string, b string, c string").repartition(3)
    expected, baskets = brute_force(table, "abc", support)
    found = tp.frequent_itemsets(df, min_support=support)
    assert (collected(found), found.baskets) == (expected, baskets)


def test_rules_equal_brute_force(spark, table):
    df = spark.createDataFrame(table, "a string, b string, c string")
    sets, baskets = brute_force(table, "abc", 0.05)
    expected = {}
    for items, freq in sets.items():
        for consequent in items if len(items) > 1 else ():
            antecedent = tuple(i for i in items if i != consequent)
            confidence = freq / sets[antecedent]
            if confidence >= 0.4:
                lift = confidence / (sets[(consequent,)] / baskets)
                expected[antecedent, consequent] = (confidence, lift, freq / baskets)
    rules = tp.association_rules(tp.frequent_itemsets(df, min_support=0.05), 0.4).collect()
    found = {
        (tuple(r["antecedent"]), r["consequent"][0]): (r["confidence"], r["lift"], r["support"])
        for r in rules
    }
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values)


def test_items_of_different_columns_may_collide(spark):
    rows = [("b_x", "x")] * 3 + [("b_x", "y"), ("c", "x")]
    df = spark.createDataFrame(rows, ["a", "a_b"])
    expected, _ = brute_force(rows, ["a", "a_b"], 0.2)
    assert collected(tp.frequent_itemsets(df, min_support=0.2)) == expected


def test_an_item_of_two_columns_is_counted_over_both(spark):
    rows = [("b_x", None)] * 5 + [(None, "x")] * 5 + [("c", "y")] * 990
    found = tp.frequent_itemsets(spark.createDataFrame(rows, "a string, a_b string"), min_support=0.008)
    assert collected(found)[("a_b_x",)] == 10


def test_sketched_candidates_miss_no_frequent_value(spark):
    """Frequent values hidden behind and between many values seen once."""
    rng = random.Random(11)
    values = ["hot"] * 340 + ["warm"] * 310 + [f"v{i}" for i in range(350)]
    for order in ("shuffled", "sorted", "last"):
        if order == "shuffled":
            rng.shuffle(values)
        elif order == "sorted":
            values.sort()
        else:
            values = [v for v in values if v[0] == "v"] + [v for v in values if v[0] != "v"]
        df = spark.createDataFrame([(v,) for v in values], ["k"])
        found = tp.frequent_itemsets(df, min_support=0.3)
        assert collected(found) == {("k_hot",): 340, ("k_warm",): 310}


def test_many_columns_use_fp_growth(spark):
    rows = [tuple("x" if (i >> j) & 1 else "y" for j in range(7)) for i in range(128)]
    columns = [f"k{j}" for j in range(7)]
    df = spark.createDataFrame(rows, columns)
    found = tp.frequent_itemsets(df, max_cols=None, min_support=0.25)
    expected, _ = brute_force(rows, columns, 0.25)
    assert collected(found) == expected


def test_only_the_first_columns_are_used(spark):
    df = spark.createDataFrame([tuple("abcdefg")], [f"k{j}" for j in range(7)])
    found = collected(tp.frequent_itemsets(df, min_support=1.0, max_cols=5))
    assert max(len(items) for items in found) == 5


def test_hot_combination_is_counted_whole(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        (F.col("id") % 2).alias("b"),
    )
    assert collected(tp.frequent_itemsets(df)) == {
        ("a_hot",): 10_000,
        ("b_0",): 15_000,
        ("b_1",): 15_000,
    }


def test_no_baskets_and_bad_arguments(spark):
    df = spark.createDataFrame([(None, None)], "a string, b int")
    found = tp.frequent_itemsets(df)
    assert (collected(found), found.baskets) == ({}, 0)
    assert tp.association_rules(found).count() == 0
    assert tp.baskets(df).count() == 0
    with pytest.raises(ValueError):
        tp.frequent_itemsets(df, min_support=0.0)


def test_top_lists_break_ties_and_trim_items(spark, table):
    df = spark.createDataFrame(table, "a string, b string, c string")
    itemsets = tp.frequent_itemsets(df, min_support=0.05)
    ranked = sorted(collected(itemsets).items(), key=lambda p: (-p[1], len(p[0]), p[0]))
    top = [(r["items"], r["freq"]) for r in tp.top_itemsets(itemsets, 10).collect()]
    assert top == [(", ".join(items), n) for items, n in ranked[:10]]
    short = tp.top_itemsets(itemsets, 100, max_items=1).collect()
    assert all(", " not in r["items"] for r in short)
    assert tp.top_rules(tp.association_rules(itemsets, 0.2), 4).count() == 4


def test_rare_support_counts_candidates(spark):
    df = spark.range(4000).select((F.col("id") % 1000).alias("k"))
    assert len(collected(tp.frequent_itemsets(df, min_support=0.001))) == 1000
    assert collected(tp.frequent_itemsets(df, min_support=0.0011)) == {}


@pytest.mark.parametrize("table_rows", [1, 7])
def test_large_tables_are_divided_without_change(spark, table_rows):
    rng = random.Random(9)
    table = [tuple(rng.choice(["u", "v", "w", None]) for _ in range(6)) for _ in range(400)]
    df = spark.createDataFrame(table, ", ".join(f"{c} string" for c in "abcdef")).repartition(3)
    expected, baskets = brute_force(table, "abcdef", 0.02)
    found = tp.frequent_itemsets(df, min_support=0.02, table_rows=table_rows)
    assert (collected(found), found.baskets) == (expected, baskets)
    assert max(map(len, expected)) >= 3


def test_conditional_itemsets_of_weighted_rows():
    rng = random.Random(2)
    rows = Counter(tuple(sorted(rng.sample(range(9), rng.randint(1, 6)))) for _ in range(200))
    expected = Counter()
    for row, weight in rows.items():
        for size in range(1, len(row) + 1):
            for part in combinations(row, size):
                expected[part] += weight
    found = list(conditional_itemsets(dict(rows), 12))
    assert len(found) == len(dict(found))
    assert dict(found) == {s: n for s, n in expected.items() if n >= 12}


def test_an_item_of_two_columns_counts_once(spark):
    # Both columns spell o_b_x, and 6 rows spell it twice; 10 of 20 rows hold it.
    rows = [("b_x", "x")] * 6 + [("b_x", None)] * 2 + [(None, "x")] * 2 + [("c", "y")] * 10
    df = spark.createDataFrame(rows, "o string, o_b string")
    assert collected(tp.frequent_itemsets(df, min_support=0.55)) == {}
    assert collected(tp.frequent_itemsets(df, min_support=0.5))[("o_b_x",)] == 10
