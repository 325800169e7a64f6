"""Connected components by alternating large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node of its component) of every node with an edge.

    ``edges`` has columns a and b; loops and repeats do no harm. A node's neighbours are
    never gathered: only their least is, by a partial aggregate, and joined back.
    """
    now = cut_lineage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), "m")
        large = large.select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), "m")
        small = moved.unionByName(low).select(
            F.greatest("u", "m").alias("u"), F.least("u", "m").alias("v")).where("u <> v")
        now = cut_lineage(small.distinct())
        after = _mark(now)
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Count and hash sums of the edges: equal when a round changed nothing."""
    return tuple(edges.agg(
        F.count("*"),
        F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))),
        F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))),
    ).first())
