"""Shards of near equal bytes by Karmarkar-Karp differencing over indivisible groups.

A partial partition is a tuple of subset sums, one for each shard. Starting from one
partial partition for each group, the two with the largest spread are combined again and
again, the largest subset of one with the smallest of the other, until one is left.

Groups are differenced in three steps, each in tasks of bounded size. First the heavy ones,
those that a block of others could not balance; there are at most ``HEAVY_SHARE`` per shard
and block, and never more than for 1024 blocks. Then all others, dealt into blocks by hash;
every block is differenced together with its part of the heavy groups' sums, so that it
makes up for them. A last small block is kept back until the sums of all the others are
known, and differenced together with those, which takes away what they leave over.

Rows of one group stay together whatever their number; a group of more than a shard's part
of all bytes makes its shard that large, and the others near equal. Null text has no bytes
and forms one group with empty text. Ids may be null or repeated. An empty table gives no
rows. Only id and text are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.llm.shared import HOT_PARTS, join_hot, numbered

SHARDS = 24
BLOCK_GROUPS = 1024
HEAVY_SHARE = 4
_LAST = -1


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine all rows of ``sums`` (partial partitions) into one.

    Returns the combined sums, in ascending order, and for each row the shard that each of
    its subsets went to.
    """
    count, shards = sums.shape
    held = [np.sort(row) for row in sums.astype(np.int64)]
    # where[i][j]: subset of node i that its j-th smallest sum comes from, for the way down
    place = [np.argsort(row, kind="stable") for row in sums]
    children: list[tuple] = [() for _ in range(count)]
    heap = [(-int(row[-1] - row[0]), i) for i, row in enumerate(held)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        merged = held[a] + held[b][::-1]
        order = np.argsort(merged, kind="stable")
        held.append(merged[order])
        held[a] = held[b] = None
        children.append((a, b, order))
        node = len(held) - 1
        heapq.heappush(heap, (-int(held[node][-1] - held[node][0]), node))
    root = heap[0][1]
    # shard_at[node][j]: shard of the node's j-th smallest subset
    shard_at: list = [None] * len(held)
    shard_at[root] = np.arange(shards)
    for node in range(len(held) - 1, count - 1, -1):
        a, b, order = children[node]
        at = np.empty(shards, dtype=np.int64)
        at[order] = shard_at[node]  # by position before sorting
        shard_at[a], shard_at[b] = at, at[::-1]
        shard_at[node] = None
    went = np.empty((count, shards), dtype=np.int64)
    for i in range(count):
        went[i, place[i]] = shard_at[i]
    return held[root], went


def beside(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Shards of the weights, differenced together with given sums of all shards."""
    rows = np.zeros((len(weights) + 1, len(sums)), dtype=np.int64)
    rows[:-1, 0] = weights
    rows[-1] = sums
    _, went = difference(rows)
    # Where each given sum went is that shard.
    shard = np.empty(len(sums), dtype=np.int64)
    shard[went[-1]] = np.arange(len(sums))
    return shard[went[:-1, 0]]


def balanced_shards(
    rows: DataFrame,
    group: str,
    size: str,
    shards: int = SHARDS,
    block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """The input with ``shard``: rows equal in ``group`` together, sums of ``size`` near equal."""
    if "shard" in rows.columns:
        rows = rows.drop("shard")
    groups = cut_lineage(rows.groupBy(group).agg(
        F.sum(size).cast("long").alias("_weight"), F.count("*").alias("_n")))
    count, total, held = groups.agg(
        F.count("*"), F.coalesce(F.sum("_weight"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    blocks = max(1, -(-count // block_groups))
    heavy = F.col("_weight") > total / (HEAVY_SHARE * shards * min(blocks, 1024))
    kind = groups.schema[group].dataType.simpleString()
    named = groups.select(F.col(group).alias("_group"), "_weight")
    block = F.pmod(F.xxhash64("_group", F.lit(7)), F.lit(blocks + 1)) + _LAST
    light = named.where(~heavy).withColumn("_block", block)

    def assigned(df: DataFrame, sums: list[int], whole: int) -> DataFrame:
        """Shards of the groups of every block, beside the block's part of ``sums``."""
        def work(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(
                ["_weight", "_group"], ascending=[False, True], ignore_index=True)
            weights = part["_weight"].to_numpy()
            share = int(weights.sum()) / max(whole, 1)
            given = np.array([round(s * share) for s in sums], dtype=np.int64)
            return part[["_group", "_weight"]].assign(
                shard=beside(weights, given).astype(np.int32))

        return cut_lineage(df.groupBy("_block").applyInPandas(
            work, f"_group {kind}, _weight long, shard int"))

    def sums_of(df: DataFrame) -> tuple[list[int], int]:
        found = {r["shard"]: r["s"] for r in
                 df.groupBy("shard").agg(F.sum("_weight").alias("s")).collect()}
        return [found.get(i, 0) for i in range(shards)], sum(found.values())

    large = assigned(named.where(heavy).withColumn("_block", F.lit(0)), [0] * shards, 1)
    first, heavy_bytes = sums_of(large)
    early = light.where(F.col("_block") != _LAST)
    weight = early.agg(F.coalesce(F.sum("_weight"), F.lit(0))).first()[0]
    middle = assigned(early, first, weight)
    both = [a + b for a, b in zip(first, sums_of(middle)[0])]
    late = light.where(F.col("_block") == _LAST)
    closing = assigned(late, both, total - heavy_bytes - weight)
    found = large.unionByName(middle).unionByName(closing).select(F.col("_group").alias(group), "shard")
    many = F.broadcast(groups.where(F.col("_n") * HOT_PARTS > held).select(group))
    return join_hot(rows, found, found.join(many, group, "left_semi"), group)


def shard_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
    overhead: int = 8,
) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard of every document.

    A size is the UTF-8 bytes of the text plus ``overhead``. Texts are compared by their
    SHA-256. Slots number the rows of a shard from 0.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = cut_lineage(docs.select(
        F.col(key),
        (F.octet_length(data) + overhead).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.unhex(F.sha2(data, 256)).alias("_digest"),
    ))
    placed = balanced_shards(rows, "_digest", "size", shards).drop("_digest")
    out = numbered(placed, ["shard"], "slot")
    return out.select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
