"""Frequent itemsets and association rules over the cells of a table.

A row is a basket with one ``column_value`` item per column. The rows of every item are
counted over all columns, as two columns may spell the same item, and frequent items are
numbered by falling count. Baskets become sets of these numbers, and equal ones one
weighted basket. Mining is FP-growth over weighted conditional tables: the table of a
suffix holds what stands before it in the baskets, equal rows as one, and gives the
tables of longer suffixes. Spark makes and groups the tables; a task mines one to the end
once it has at most ``TABLE_ROWS`` different rows, larger ones are divided by their
next item. The itemsets are written once to the shared folder and read from there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile import defaults
from tableprofile.functions.checkpoints import cut_lineage, scratch_path
from tableprofile.functions.columns import named
from tableprofile.operators.features import basket_columns, item

TABLE_ROWS = 20_000


@dataclass(frozen=True)
class Itemsets:
    """Frequent itemsets ``(items, freq)`` and the number of baskets."""

    frame: DataFrame
    baskets: int
    min_support: float


def frequent_itemsets(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    min_support: float = defaults.MIN_SUPPORT,
    max_cols: int | None = defaults.BASKET_COLUMNS,
    table_rows: int = TABLE_ROWS,
) -> Itemsets:
    """Itemsets present in at least ``min_support`` of the baskets.

    NULLs are no items and rows of NULLs only are no baskets. ``table_rows`` bounds what
    one task mines and changes no result.
    """
    if not 0 < min_support <= 1:
        raise ValueError("min_support must lie in (0, 1]")
    chosen = basket_columns(df, columns, max_cols)
    some = reduce(lambda a, b: a | b, [named(c).isNotNull() for c in chosen], F.lit(False))
    rows = df.where(some)
    total = rows.count()
    least = max(1, math.ceil(min_support * total))
    items = _candidate_items(rows, chosen, least)
    weighted = cut_lineage(_weighted_baskets(rows, chosen, items))
    singles = (
        weighted.select(F.explode("ranks").alias("rank"), "weight")
        .groupBy("rank").agg(F.sum("weight").alias("freq")).where(F.col("freq") >= least)
        .select(F.array("rank").alias("ranks"), "freq")
    )
    found = reduce(DataFrame.unionByName, [singles, *_mined(weighted, least, table_rows)])
    spelled = (
        found.select("ranks", "freq", F.explode("ranks").alias("rank"))
        .join(items.select("rank", "item"), "rank")
        .groupBy("ranks", "freq").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    return Itemsets(cut_lineage(spelled.select("items", "freq")), total, min_support)


def _candidate_items(rows: DataFrame, columns: Sequence[str], least: int) -> DataFrame:
    """``(item, rank)`` of all items that may be frequent, ranks rising with falling count.

    Columns are counted one by one and their counts added up, which is too much only where
    a row spells an item twice. Written to the shared folder, so that Spark knows the size
    when it plans the joins.
    """
    counted = [rows.groupBy(item(c).alias("item")).agg(F.count(F.lit(1)).alias("n")) for c in columns]
    summed = reduce(DataFrame.unionByName, counted).where("item is not null").groupBy("item").agg(
        F.sum("n").alias("n"))
    path = scratch_path(rows.sparkSession, "items")
    # Sorted rows get rising numbers, with gaps between partitions.
    summed.where(F.col("n") >= least).orderBy(F.desc("n"), "item").select(
        "item", F.monotonically_increasing_id().alias("rank")).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _weighted_baskets(rows: DataFrame, columns: Sequence[str], items: DataFrame) -> DataFrame:
    """Different sets of candidates ``ranks`` and the number of rows that hold them."""
    held = rows.select(*[item(c).alias(f"i{k}") for k, c in enumerate(columns)])
    for k in range(len(columns)):
        own = items.select(F.col("item").alias(f"i{k}"), F.col("rank").alias(f"r{k}"))
        held = held.join(own, f"i{k}", "left").drop(f"i{k}")
    ranks = [f"r{k}" for k in range(len(columns))]
    # Equal rows become one before any set is made of them.
    alike = held.groupBy(*ranks).agg(F.count(F.lit(1)).alias("n"))
    return (
        alike.groupBy(F.array_sort(F.array_distinct(F.array_compact(F.array(*ranks)))).alias("ranks"))
        .agg(F.sum("n").alias("weight")).where(F.size("ranks") > 0)
    )


def _mined(weighted: DataFrame, least: int, table_rows: int) -> Iterator[DataFrame]:
    """Itemsets ``(ranks, freq)`` of two items and more, a frame for each round."""
    empty = F.array().cast("array<bigint>")
    tables = weighted.select(empty.alias("suffix"), F.col("ranks").alias("prefix"), "weight")

    def mine(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        rows = {tuple(p): w for p, w in zip(df["prefix"], df["weight"])}
        found = [((*suffix, *key[0]), n) for suffix, n in conditional_itemsets(rows, least)]
        return pd.DataFrame(found, columns=["ranks", "freq"])

    while True:
        longer = tables.select("suffix", "prefix", "weight", F.posexplode("prefix").alias("at", "rank"))
        tables = cut_lineage(
            longer.where("at > 0")
            .groupBy(
                F.concat(F.array("rank"), "suffix").alias("suffix"),
                F.slice("prefix", 1, F.col("at")).alias("prefix"))
            .agg(F.sum("weight").alias("weight"))
        )
        large = cut_lineage(
            tables.groupBy("suffix").count().where(F.col("count") > table_rows).select("suffix"))
        yield (
            tables.join(large, "suffix", "left_anti").groupBy("suffix")
            .applyInPandas(mine, "ranks array<bigint>, freq bigint")
        )
        if large.isEmpty():
            return
        tables = tables.join(large, "suffix", "left_semi")
        counted = (
            tables.select("suffix", "weight", F.explode("prefix").alias("rank"))
            .groupBy("suffix", "rank").agg(F.sum("weight").alias("freq"))
            .where(F.col("freq") >= least)
        )
        yield counted.select(F.concat(F.array("rank"), "suffix").alias("ranks"), "freq")
        kept = counted.groupBy("suffix").agg(F.collect_list("rank").alias("kept"))
        tables = tables.join(kept, "suffix").select(
            "suffix", F.array_intersect("prefix", "kept").alias("prefix"), "weight")


def conditional_itemsets(
    rows: dict[tuple[int, ...], int], least: int
) -> Iterator[tuple[tuple[int, ...], int]]:
    """Frequent itemsets of a table of different sorted rows with weights."""
    counts: dict[int, int] = {}
    for row, weight in rows.items():
        for x in row:
            counts[x] = counts.get(x, 0) + weight
    tables: dict[int, dict[tuple[int, ...], int]] = {x: {} for x, n in counts.items() if n >= least}
    for row, weight in rows.items():
        kept = tuple(x for x in row if x in tables)
        for at in range(1, len(kept)):
            table = tables[kept[at]]
            table[kept[:at]] = table.get(kept[:at], 0) + weight
    for x, table in tables.items():
        yield (x,), counts[x]
        for before, n in conditional_itemsets(table, least):
            yield (*before, x), n


def association_rules(
    itemsets: Itemsets, min_confidence: float = defaults.MIN_CONFIDENCE
) -> DataFrame:
    """Rules with one consequent item: confidence, lift and support.

    Every subset of a frequent itemset is frequent, so both sides of a rule are
    found among the itemsets by equi-joins on the item arrays.
    """
    found = itemsets.frame
    total = F.lit(float(itemsets.baskets))
    whole = found.filter(F.size("items") > 1).select(
        "items", "freq", F.explode("items").alias("consequent")
    )
    split = whole.select(
        F.array_except("items", F.array("consequent")).alias("antecedent"),
        "consequent",
        "freq",
    )
    before = found.select(
        F.col("items").alias("antecedent"), F.col("freq").alias("antecedent_freq")
    )
    after = found.filter(F.size("items") == 1).select(
        F.col("items")[0].alias("consequent"), F.col("freq").alias("consequent_freq")
    )
    confidence = F.col("freq") / F.col("antecedent_freq")
    return (
        split.join(before, "antecedent")
        .withColumn("confidence", confidence)
        .filter(F.col("confidence") >= F.lit(min_confidence))
        .join(after, "consequent")
        .select(
            "antecedent",
            F.array("consequent").alias("consequent"),
            "confidence",
            (F.col("confidence") / (F.col("consequent_freq") / total)).alias("lift"),
            (F.col("freq") / total).alias("support"),
        )
    )


def join_items(column: str, max_items: int | None = None) -> Column:
    """Items as one text, at most the first ``max_items`` of them."""
    items = F.col(column) if max_items is None else F.slice(column, 1, max_items)
    return F.array_join(items, ", ")


def top_itemsets(
    itemsets: Itemsets, top_n: int = defaults.TOP_PATTERNS, max_items: int | None = None
) -> DataFrame:
    """The most frequent itemsets; equal counts in item order."""
    ranked = itemsets.frame.orderBy(F.desc("freq"), F.size("items"), F.col("items")).limit(top_n)
    return ranked.select(join_items("items", max_items).alias("items"), "freq")


def top_rules(
    rules: DataFrame,
    top_n: int = defaults.TOP_PATTERNS,
    max_items: int | None = None,
    digits: int | None = defaults.RATIO_DIGITS,
) -> DataFrame:
    """The most confident rules; equal confidence in antecedent, consequent order."""
    ranked = rules.orderBy(F.desc("confidence"), "antecedent", "consequent").limit(top_n)
    confidence = F.col("confidence") if digits is None else F.round("confidence", digits)
    return ranked.select(
        join_items("antecedent", max_items).alias("antecedent"),
        join_items("consequent", max_items).alias("consequent"),
        confidence.alias("confidence"),
    )
