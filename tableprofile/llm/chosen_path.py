"""N-gram Jaccard join by chosen paths (Christiani and Pagh, 2017; CPSJoin, 2018).

A text's set holds the hashes of its runs of five words. Texts with equal sets are joined
as one. Every set samples tokens with shared randomness: a token is chosen if its hash is
under a threshold of about ``tokens_per_run`` over the size of the set, so that similar
sets choose common tokens. Sets that chose the same token share a bucket. Runs with other
hashes are repeated until the expected recall at the threshold reaches ``recall``.

Small buckets are compared by brute force. A larger one is split: first by bands of size,
as sets of too different size cannot link, then on further sampled tokens (its path grows
by one), leaving out those that over half of the bucket has, as a line or passage that
many texts share would keep the bucket together. Sets that consist mostly of such tokens
are alike; they are compared with each other there. (If only one of a linked pair is alike,
or none, at least a fifth of their tokens are common but not shared by half.) What is left
after ``max_depth`` splits is compared whatever its size. Pairs whose samples of about 64
tokens overlap by over four standard deviations less than a linked pair's are expected to
are left out of the exact comparison, which takes the whole sets. Buckets of more than
``chunk`` sets are compared in pairs of chunks, each a group of its own, so no task holds
a bucket.

A pair that shares several buckets belongs to the one with the least id, so each pair is
compared and counted once. Buckets put out, for each set, how many texts it links to and
one edge to the least set that it is connected with there: no row for each pair.

Words are runs of other than \\x20 and \\x09-\\x0D; a text of one to four words is one
n-gram. Null texts and texts without a word link to nothing: each is a class of its own.
Rows with equal ids each count as a row; null ids are carried along and never lead a class
that holds another id. Ties cannot occur: a pair links if its similarity is at least the
threshold. An empty table gives no rows. Only id and text are read.

Sets are compared by 32-bit hashes of n-grams: among 400 distinct ones about 2 in 100,000
sets hold a pair of equal hashes, which changes a size by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.llm.components import connected_components
from tableprofile.llm.shared import by_size, groups_in, mixed

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
TOKENS_PER_RUN = 3.0
SPLIT_TOKENS = 3.0
POOL = 64
SMALL_BUCKET = 1024
MAX_DEPTH = 2
ALIKE = 0.6
CHUNK = 256
SAMPLE_SHARE = 0.3
PAIRS_AT_ONCE = 1 << 16


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words."""
    import xxhash

    parts = (text or "").encode("utf-8", "replace").split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(one))
    total = np.zeros(len(one) - width + 1, dtype=np.uint64)
    for shift in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + one[shift : shift + len(total)]
    return np.unique(mixed(total, 1))


def runs_for(recall: float, threshold: float, tokens_per_run: float) -> int:
    """Runs until a pair at the threshold shares a chosen token with the wanted chance."""
    return max(1, math.ceil(math.log(1 - recall) / (-tokens_per_run * threshold)))


def sampled(tokens: np.ndarray, pool: int) -> np.ndarray:
    """A shared sample of about ``pool`` tokens, all of them in a small set."""
    if len(tokens) <= pool:
        return tokens
    limit = np.uint64(int(2**64 * pool / len(tokens)))
    return tokens[mixed(tokens, 2) < limit]


def choose(tokens: np.ndarray, rate: float, seed: int) -> np.ndarray:
    """Tokens whose hash for this path is under the rate."""
    if rate >= 1:
        return tokens
    return tokens[mixed(tokens, seed) < np.uint64(int(2**64 * rate))]


def _sketch_rows(key_type, words, runs, tokens_per_run, pool):
    import hashlib

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in by_size(batch):
                sid, size, pools, chosen, samples = [], [], [], [], []
                for text in texts:
                    tokens = shingles(text, words)
                    own = sampled(tokens, pool)
                    rate = tokens_per_run / max(min(pool, len(tokens)), 1)
                    picks = [
                        mixed(choose(own, rate, 100 + r), 200 + r) for r in range(runs)
                    ] if len(tokens) else []
                    picks = np.unique(np.concatenate(picks)) if picks else own
                    sid.append(
                        hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                        if len(tokens) else None
                    )
                    size.append(len(tokens))
                    pools.append((own >> np.uint64(32)).astype(np.uint32).view(np.int32))
                    short = np.unique((own >> np.uint64(48)).astype("<u2"))
                    samples.append(short.tobytes())
                    chosen.append(picks.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(sid, pa.binary()), pa.array(size, pa.int64()),
                     pa.array(pools, pa.list_(pa.int32())),
                     pa.array(chosen, pa.list_(pa.int64())), pa.array(samples, pa.binary())],
                    names=["_key", "sid", "n", "pool", "chosen", "sample"],
                )

    return rows, (f"_key {key_type}, sid binary, n long, pool array<int>, "
                  "chosen array<long>, sample binary")


def _full_sets(words):
    import hashlib

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in by_size(batch):
                found = [t for t in (shingles(x, words) for x in texts) if len(t)]
                sid = [hashlib.blake2b(t.tobytes(), digest_size=16).digest() for t in found]
                # The upper halves; sorted like the whole.
                sets = [np.unique((t >> np.uint64(32)).astype("<u4")).tobytes() for t in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sid, pa.binary()), pa.array(sets, pa.binary())], names=["sid", "set"]
                )

    return rows, "sid binary, set binary"


def _leaves(sets: DataFrame, small: int, depth: int, threshold: float, pool: int):
    """Buckets to compare: leaf, sid, m (sets in the leaf)."""
    known = sets.select("sid", "n", "pool")
    paths = sets.select(F.explode("chosen").alias("path"), "sid")
    leaves = []
    for level in range(depth):
        paths = _sized(paths)
        leaves.append(paths.where(F.col("m") <= small))
        # Sets that can link are in the same or neighbouring bands of size. A bucket holds
        # the sets of its band, if there are any, and those of the band below.
        band = F.floor(F.log("n") / float(-math.log(threshold)))
        hot = paths.where(F.col("m") > small).join(known, "sid").select(
            F.explode(F.array(band, band + 1)).alias("band"), band.alias("own"), "path", "sid")
        hot = _sized(hot.select(
            F.xxhash64("path", "band").alias("path"), "sid", "band",
            (F.col("band") == F.col("own")).alias("home")), "band", "home")
        leaves.append(hot.where(F.col("m") <= small).select("path", "sid", "m"))
        hot = hot.where(F.col("m") > small)
        if hot.isEmpty():
            paths = None
            break
        hot = cut_lineage(hot.join(known, "sid"))
        # Tokens of over half of a bucket's sets: at most two pools of them.
        common = (
            hot.select("path", "m", F.explode("pool").alias("token"))
            .groupBy("path", "m", "token").agg(F.count("*").alias("c"))
            .where(F.col("c") > F.col("m") / 2)
            .groupBy("path").agg(F.collect_list("token").alias("common"))
        )
        hot = cut_lineage(hot.join(common, "path", "left").select(
            "path", "sid", "band", F.array_min("common").alias("first"),
            F.array_except("pool", F.coalesce("common", F.array().cast("array<int>")))
            .alias("rest"), F.size("pool").alias("size"),
        ))
        # A group of alike sets has many paths, but the same first common token on most.
        alike = hot.where(F.size("rest") <= (1 - ALIKE) * F.col("size")).select(
            F.xxhash64("first", "band", F.lit(-1 - level)).alias("path"), "sid").distinct()
        leaves.append(_sized(alike))
        # A longer path takes one of the other tokens, by a hash of path and token. A set
        # with over nine tenths of common tokens can link to alike sets only.
        rate = F.lit(SPLIT_TOKENS) / F.size("rest")
        draw = lambda t: F.pmod(F.xxhash64(F.col("path"), t), F.lit(1 << 30)) / float(1 << 30)
        split = hot.where(F.size("rest") >= 0.1 * F.col("size"))
        paths = split.select(
            F.explode(F.filter("rest", lambda t: draw(t) < rate)).alias("token"), "path", "sid",
        ).select(F.xxhash64("path", "token", F.lit(level)).alias("path"), "sid")
    if paths is not None:
        leaves.append(_sized(paths))
    every = leaves[0]
    for more in leaves[1:]:
        every = every.unionByName(more)
    return every.select(F.col("path").alias("leaf"), "sid", "m")


def _sized(paths: DataFrame, *more: str) -> DataFrame:
    """Rows of paths that two sets or more have, with their number m.

    Where rows say if they are at home, one set at least has to be.
    """
    paths = cut_lineage(paths)
    home = F.max("home") if "home" in more else F.lit(True)
    sizes = paths.groupBy("path").agg(F.count("*").alias("m"), home.alias("_any"))
    sizes = sizes.where("m > 1 and _any").select("path", "m")
    return paths.join(sizes, "path").select("path", "sid", "m", *[c for c in more if c != "home"])


def _dealt(leaves: DataFrame, chunk: int) -> DataFrame:
    """Large leaves as pairs of chunks: adds first and second chunk of the group, own side."""
    parts = F.ceil(F.col("m") / chunk).cast("int")
    own = F.pmod(F.xxhash64("sid", "leaf"), parts).cast("int")
    return (
        leaves.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .drop("other")
    )


def candidate_pairs(
    group: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray, size: np.ndarray,
    leaf: np.ndarray, lists: list[np.ndarray], threshold: float,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group that belong to its leaf and whose sizes allow a link.

    Groups of two chunks hold pairs between the chunks, groups of one pairs within it.
    """
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    stops = np.r_[starts[1:], len(group)]
    partners = np.repeat(stops, stops - starts) - np.arange(len(group)) - 1
    width = max(map(len, lists))
    table = np.full((len(lists), width), np.iinfo(np.int64).max)
    for row, found in enumerate(lists):
        table[row, : len(found)] = found
    ends = np.cumsum(partners)
    at = 0
    while at < len(group):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE)))
        count = partners[at:stop]
        a = np.repeat(np.arange(at, min(stop, len(group))), count)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
        fit = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b])
        fit &= (i[a] == j[a]) | (own[a] != own[b])
        a, b = a[fit], b[fit]
        mine = np.ones(len(a), dtype=bool)
        for column in range(width):
            value = table[a, column]
            open_ = mine & (value < leaf[a])
            if not open_.any():
                continue
            rows = np.flatnonzero(open_)
            shared = (table[b[rows]] == value[rows, None]).any(axis=1)
            mine[rows[shared]] = False
        yield a[mine], b[mine]
        at = stop


def overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common tokens of the pairs (a, b) of sorted sets."""
    if len(a) <= 4 * len(sets):
        return np.array([
            len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            for x, y in zip(a.tolist(), b.tolist())
        ], dtype=np.int64)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], rows[order]
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    count = np.diff(np.r_[starts, len(tokens)])
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    often = np.flatnonzero(count > 8)
    for at in range(0, len(often), 4096):
        own = often[at : at + 4096]
        block = np.zeros((len(sets), len(own)), dtype=np.float32)
        for column, k in enumerate(own.tolist()):
            block[rows[starts[k] : starts[k] + count[k]], column] = 1
        shared += block @ block.T
    for f in range(2, 9):
        heads = starts[count == f]
        for x, y in combinations(range(f), 2):
            np.add.at(shared, (rows[heads + x], rows[heads + y]), 1)
            np.add.at(shared, (rows[heads + y], rows[heads + x]), 1)
    return shared[a, b].astype(np.int64)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row that each row is connected with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _group_ids(table: pa.Table) -> np.ndarray:
    leaf, i, j = (_numbers(table, c) for c in ("leaf", "i", "j"))
    new = np.r_[True, (leaf[1:] != leaf[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
    return np.cumsum(new)


def _all_pairs(table: pa.Table, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    flat = table.column("leaves").combine_chunks()
    lists = [np.asarray(x) for x in np.split(
        flat.flatten().to_numpy(), flat.offsets.to_numpy()[1:-1] - flat.offsets.to_numpy()[0])]
    return candidate_pairs(
        _group_ids(table), *(_numbers(table, c) for c in ("own", "i", "j", "n", "leaf")),
        lists, threshold)


def _needed_rows(threshold, pool):
    """Rows of sets that have a pair to compare in their group; drops the samples."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in(batches, 3):
            used = np.zeros(table.num_rows, dtype=bool)
            samples = [np.frombuffer(x, "<u2") for x in table.column("sample").to_pylist()]
            least = SAMPLE_SHARE * np.minimum(_numbers(table, "n"), pool)
            group = _group_ids(table)
            for pairs in _all_pairs(table, threshold):
                for a, b in _by_group(group, *pairs):
                    first = int(min(a.min(), b.min()))
                    last = int(max(a.max(), b.max())) + 1
                    common = overlaps(samples[first:last], a - first, b - first)
                    near = common >= np.maximum(least[a], least[b])
                    used[a[near]] = used[b[near]] = True
            kept = table.drop_columns(["sample"]).filter(pa.array(used))
            yield from kept.combine_chunks().to_batches()

    return rows


def _linked_rows(threshold):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in(batches, 3):
            sets = [np.frombuffer(x, "<u4") for x in table.column("set").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            copies = _numbers(table, "copies")
            degree = np.zeros(len(sets), dtype=np.int64)
            linked_a, linked_b = [], []
            group = _group_ids(table)
            for a, b in _all_pairs(table, threshold):
                for x, y in _by_group(group, a, b):
                    first = int(min(x.min(), y.min()))
                    last = int(max(x.max(), y.max())) + 1
                    common = overlaps(sets[first:last], x - first, y - first)
                    link = common >= threshold * (sizes[x] + sizes[y] - common) - 1e-9
                    linked_a.append(x[link])
                    linked_b.append(y[link])
            if not linked_a:
                continue
            a, b = np.concatenate(linked_a), np.concatenate(linked_b)
            np.add.at(degree, a, copies[b])
            np.add.at(degree, b, copies[a])
            root = local_roots(len(sets), a, b)
            at = np.flatnonzero(degree)
            sid = table.column("sid").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [sid.take(pa.array(at)), sid.take(pa.array(root[at])),
                 pa.array(degree[at], pa.int64())],
                names=["sid", "hub", "links"],
            )

    return rows


def _by_group(group, a, b):
    """The pairs cut where their group changes; pairs come in order of ``a``."""
    if not len(a):
        return
    cuts = np.flatnonzero(np.diff(group[a])) + 1
    yield from zip(np.split(a, cuts), np.split(b, cuts))


def similarity_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    tokens_per_run: float = TOKENS_PER_RUN,
    small_bucket: int = SMALL_BUCKET,
    max_depth: int = MAX_DEPTH,
    chunk: int = CHUNK,
) -> DataFrame:
    """key, class_id (least key of the texts it is connected with) and n_links of every row.

    ``n_links`` counts the other rows whose similarity is at least the threshold.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                2 * spark.sparkContext.defaultParallelism)
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = source.schema[0].dataType.simpleString()
    runs = runs_for(recall, threshold, tokens_per_run)
    work, schema = _sketch_rows(kind, words, runs, tokens_per_run, POOL)
    base = cut_lineage(source.mapInArrow(work, schema))
    sets = cut_lineage(
        base.where("sid is not null").groupBy("sid").agg(
            F.count("*").alias("copies"), F.min("_key").alias("lead"), F.min("n").alias("n"),
            F.min("pool").alias("pool"), F.min("chosen").alias("chosen"),
            F.min("sample").alias("sample"))
    )
    leaves = cut_lineage(_leaves(sets, small_bucket, max_depth, threshold, POOL))
    lists = leaves.groupBy("sid").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    known = lists.join(sets.select("sid", "copies", "n", "sample"), "sid")
    rows = _dealt(leaves, chunk).join(known, "sid").select(
        "leaf", "i", "j", "own", "sid", "n", "copies", "leaves", "sample")
    order = ["leaf", "i", "j"]
    needed = cut_lineage(
        rows.repartition(parts, *order).sortWithinPartitions(*order)
        .mapInArrow(_needed_rows(threshold, POOL), rows.drop("sample").schema)
    )
    work, schema = _full_sets(words)
    whole = source.select("_text").mapInArrow(work, schema)
    wanted = needed.select("sid").distinct()
    whole = whole.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first("set").alias("set"))
    found = cut_lineage(
        needed.join(whole, "sid")
        .select(*needed.columns, "set")
        .repartition(parts, *order).sortWithinPartitions(*order)
        .mapInArrow(_linked_rows(threshold), "sid binary, hub binary, links long")
    )
    roots = connected_components(found.select(F.col("sid").alias("a"), F.col("hub").alias("b")))
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    info = (
        sets.select("sid", "copies", "lead")
        .join(links, "sid", "left")
        .join(roots.withColumnRenamed("node", "sid"), "sid", "left")
        .withColumn("root", F.coalesce("root", "sid"))
    )
    leads = info.groupBy("root").agg(F.min("lead").alias("class_id"))
    per_set = info.join(leads, "root").select(
        "sid", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    kept = base.select("_key", "sid")
    alone = kept.where("sid is null").select(
        F.col("_key").alias(key), F.col("_key").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"))
    return kept.join(per_set, "sid").select(
        F.col("_key").alias(key), "class_id", "n_links").unionByName(alone)
