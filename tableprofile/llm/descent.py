"""Approximate nearest neighbours by NN-descent (Dong, Moses and Li, 2011).

Equal vectors are one node, so copies cannot fill each other's neighbour lists. The graph
starts from brute force inside small leaves of random hyperplanes. A round then joins every
node's neighbours with their vectors and bounds, and with the nodes that it is a neighbour
of: neighbours of a node, and their neighbours, are compared where at least one of the two
links is new, and a pair is passed on if it beats the worst neighbour of one of its ends.
Every node keeps its best ``neighbours``. Rounds go on until few links are new: they end, as
a list only ever gets better. Widths grow with the number of vectors (``widths_for``).

Queries search the graph greedily. A query holds the best ``beam`` nodes that it has seen;
in a step it visits the best ones not yet visited, until none of its beam is left to visit.
The vector of a query travels to the nodes it visits, which answer with the neighbours that
are not worse than its whole beam. A query whose vector is a node starts there. All of the
beam that the error of the bytes leaves a place among the results is compared again in double
precision on the original vectors, and its nodes are replaced by the rows that hold them.

Rounds and steps read what the one before wrote, whose files are dropped after each.

Vectors travel as signed bytes with a scale. A list of nodes that a node is a neighbour of
is dealt over several groups where it is long (hubs), each with the node's own neighbours,
and no pairs within it are formed, so work per link is bounded. No list is cut.

Vectors that are null, zero or hold a null or non-finite component take no part, as query
or candidate; so do rows without an id. Repeated rows (equal id and vector) count once.
Ties go to the smaller id. With five candidates or fewer all are returned. An empty table
gives no rows. All vectors need the same length; the commonest is taken and others left
out. Only id and vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import cut_lineage, release
from tableprofile.llm.shared import groups_in, numbered

# Least widths, for MEASURED nodes or fewer; see ``widths_for``.
NEIGHBOURS = 26
BEAM = 400
VISITS = 64
MEASURED = 51282
LEAF = 1024
TABLES = 6
STOP_SHARE = 0.02
HUB_LINKS = 2048
# Rows of a task in a shuffle of links, and visits whose nodes are sent to every task.
TASK_ROWS = 1 << 20
FEW_VISITS = 1 << 16


def widths_for(count: int) -> tuple[int, int, int]:
    """Neighbours, beam and visits for a number of distinct vectors.

    With each doubling beyond MEASURED there are 2.6 more neighbours, and the beam grows by
    2 ** 0.71, as from 20 and 128 on 10,256 vectors to 26 and 400 on 51,282, which had about
    the same recall. Visits grow with the beam, so that steps do not.
    """
    doublings = max(0.0, math.log2(max(count, 1) / MEASURED))
    beam = math.ceil(BEAM * 2 ** (0.71 * doublings))
    return NEIGHBOURS + math.ceil(2.6 * doublings), beam, VISITS * beam // BEAM


def packed(vectors: np.ndarray) -> list[bytes]:
    """Rows as a scale and signed bytes; the products of two approximate their cosine."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    whole = np.rint(unit / scale).astype(np.int8)
    return [a.tobytes() + b.tobytes() for a, b in zip(scale.astype("<f4"), whole)]


def unpacked(rows: list[bytes]) -> np.ndarray:
    return _unpacked(b"".join(rows), len(rows))


def _unpacked(rows: bytes, count: int) -> np.ndarray:
    raw = np.frombuffer(rows, np.uint8).reshape(count, -1)
    scale = np.ascontiguousarray(raw[:, :4]).view("<f4")
    return raw[:, 4:].view(np.int8).astype(np.float32) * scale


def _column(batch, name: str) -> pa.Array:
    found = batch.column(name)
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def _lists(batch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the lists of a column begin and end, and their values."""
    found = _column(batch, name)
    return found.offsets.to_numpy(), found.values.to_numpy(zero_copy_only=False)


def vector_nodes(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct usable vectors, scaled by a power of two: node, vec, packed, error, members.

    Members are the six least ids; the error is the distance of the packed from the unit vector. Vectors that differ by a power of two alone are one node;
    all their cosines are equal.
    """
    vec = F.col(vector).cast("array<double>")
    usable = (
        rows.select(F.col(key).alias("id"), vec.alias("vec"))
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull())
        .where(~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        .where(F.exists("vec", lambda x: x != 0))
        .withColumn("width", F.size("vec"))
    )
    widths = usable.groupBy("width").count().orderBy(F.desc("count"), "width").limit(1).collect()
    usable = usable.where(F.col("width") == (widths[0]["width"] if widths else 0)).drop("width")
    usable = usable.withColumn("vec", _scaled(F.col("vec")))
    usable = usable.withColumn("h1", F.xxhash64("vec")).withColumn(
        "h2", F.xxhash64(F.lit(1), "vec"))
    ranked = numbered(
        usable.select("id", "h1", "h2").distinct().orderBy("id"), ["h1", "h2"], "place")
    members = ranked.where("place < 6").groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list("id")).alias("members"))
    vectors = usable.groupBy("h1", "h2").agg(F.first("vec").alias("vec"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1)
            rows = packed(flat)
            unit = flat / np.linalg.norm(flat, axis=1, keepdims=True)
            error = np.linalg.norm(unpacked(rows) - unit, axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.binary()), pa.array(error)],
                names=[*batch.schema.names, "packed", "error"])

    joined = vectors.join(members, ["h1", "h2"]).select("vec", "members")
    kind = rows.schema[key].dataType.simpleString()
    return cut_lineage(
        joined.mapInArrow(pack, f"vec array<double>, members array<{kind}>, packed binary, error double")
        .withColumn("node", F.monotonically_increasing_id()))


def _scaled(vec: Column) -> Column:
    """Times the power of two that brings its largest component near one, in two halves.

    That changes no cosine by a bit, and products neither overflow nor vanish.
    """
    power = -F.floor(F.log2(F.array_max(F.transform(vec, F.abs))))
    half = F.floor(power / 2)
    one, two = F.pow(F.lit(2.0), half), F.pow(F.lit(2.0), power - half)
    return F.transform(vec, lambda x: x * one * two)


def best_of(
    owner: np.ndarray, other: np.ndarray, sims: np.ndarray, most: int
) -> np.ndarray:
    """Rows of the best ``most`` distinct partners of each owner, best first."""
    order = np.lexsort((sims, other, owner))[::-1]
    o, p = owner[order], other[order]
    order = order[np.r_[True, (o[1:] != o[:-1]) | (p[1:] != p[:-1])]] if len(order) else order
    order = order[np.lexsort((other[order], -sims[order], owner[order]))]
    o = owner[order]
    first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]]) if len(o) else np.empty(0, np.int64)
    place = np.arange(len(o)) - np.repeat(first, np.diff(np.r_[first, len(o)]))
    return order[place < most]


_LINKS = "u long, v long, s float"


def _links(u, v, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float32())],
        names=["u", "v", "s"])


def _leaf_links(nodes: DataFrame, count: int, width: int, k: int, leaf: int, tables: int):
    """First links: the best partners within leaves of random hyperplanes."""
    bits = max(0, int(np.ceil(np.log2(max(count, 1) / leaf))))
    planes = np.random.default_rng(8).normal(size=(tables, bits, width)).astype(np.float32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = unpacked(batch.column("packed").to_pylist())
            for t in range(tables):
                side = (own @ planes[t].T > 0).astype(np.int64)
                key = side @ weight * tables + t if bits else np.full(len(own), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), batch.column("node"), batch.column("packed")],
                    names=["leaf", "node", "packed"])

    dealt = cut_lineage(
        nodes.select("node", "packed").mapInArrow(deal, "leaf long, node long, packed binary"))
    sizes = dealt.groupBy("leaf").agg(F.ceil(F.count("*") / (2 * leaf)).alias("parts"))
    spread = dealt.join(sizes, "leaf").select(
        "leaf", F.pmod(F.xxhash64("node", "leaf"), F.col("parts")).alias("part"), "node", "packed")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in(batches, 2):
            leaf_, part, node = (_column(table, c).to_numpy() for c in ("leaf", "part", "node"))
            vec = unpacked(_column(table, "packed").to_pylist())
            new = np.flatnonzero(
                np.r_[True, (leaf_[1:] != leaf_[:-1]) | (part[1:] != part[:-1])])
            for a, b in zip(new, np.r_[new[1:], len(node)]):
                sims = vec[a:b] @ vec[a:b].T
                np.fill_diagonal(sims, -2)
                m = min(k, b - a - 1)
                if m < 1:
                    continue
                top = np.argpartition(-sims, m - 1, axis=1)[:, :m]
                yield _links(np.repeat(node[a:b], m), node[a:b][top].ravel(),
                             np.take_along_axis(sims, top, 1).ravel())

    keys = ["leaf", "part"]
    return (
        spread.repartition(_parts(nodes, count * tables), *keys).sortWithinPartitions(*keys)
        .mapInArrow(compare, _LINKS)
    )


def _parts(df: DataFrame, rows: int = 0) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               2 * spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def _best_links(links: DataFrame, k: int, rows: int) -> DataFrame:
    """u, nbrs: the k best distinct partners as (s, v, fresh), best first.

    ``links``, about so many rows, has u, v, s, old (false for a link that is new in this round).
    """
    spread = links.repartition(_parts(links, rows), "u")
    one = spread.groupBy("u", "v").agg(F.max("s").alias("s"), (~F.max("old")).alias("fresh"))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return (
        one.withColumn("place", place).where(F.col("place") <= k)
        .groupBy("u").agg(F.sort_array(F.collect_list(
            F.struct((-F.col("s")).alias("far"), "v", "fresh"))).alias("nbrs"))
    )


def _round_links(k: int):
    """Pairs found around each node, from rows sorted by node, group and role."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in(batches, 2):
            center, salt, role = (_column(table, c).to_numpy() for c in ("center", "salt", "role"))
            other = _column(table, "other").to_numpy()
            bound = _column(table, "bound").to_numpy()
            fresh = _column(table, "fresh").to_numpy(zero_copy_only=False)
            vec = unpacked(_column(table, "packed").to_pylist())
            new = np.flatnonzero(
                np.r_[True, (center[1:] != center[:-1]) | (salt[1:] != salt[:-1])])
            u, v, s = [], [], []
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(center)]):
                f = a + int(np.count_nonzero(role[a:b] == 0))
                if f == a:
                    continue
                sims = vec[a:f] @ vec[a:b].T
                fit = fresh[a:f, None] | fresh[None, a:b]
                if salt[a]:  # the pairs of neighbours belong to the first group
                    fit[:, : f - a] = False
                fit &= other[a:f, None] != other[None, a:b]
                x, y = np.nonzero(fit & (sims > bound[a:f, None]))
                u.append(other[a + x])
                v.append(other[a + y])
                s.append(sims[x, y])
                x, y = np.nonzero(fit & (sims > bound[None, a:b]))
                u.append(other[a + y])
                v.append(other[a + x])
                s.append(sims[x, y])
            if not u:
                continue
            u, v, s = np.concatenate(u), np.concatenate(v), np.concatenate(s)
            keep = best_of(u, v, s, k)
            yield _links(u[keep], v[keep], s[keep])

    return rows


def neighbour_graph(
    nodes: DataFrame,
    neighbours: int = NEIGHBOURS,
    leaf: int = LEAF,
    tables: int = TABLES,
    stop_share: float = STOP_SHARE,
) -> DataFrame:
    """u and nbrs of every node that has another; see ``_best_links``."""
    count = nodes.count()
    width = len(nodes.select("packed").first()[0]) - 4 if count else 0
    first = _leaf_links(nodes, count, width, neighbours, leaf, tables)
    graph = cut_lineage(_best_links(
        first.withColumn("old", F.lit(False)), neighbours, count * neighbours * tables))
    release(nodes.sparkSession)
    while True:
        graph = _next_graph(nodes, graph, neighbours, count)
        release(nodes.sparkSession)
        changed = graph.agg(F.sum(F.size(F.filter("nbrs", lambda n: n["fresh"])))).first()[0]
        if (changed or 0) <= stop_share * count * neighbours:
            return graph


def _next_graph(nodes: DataFrame, graph: DataFrame, neighbours: int, count: int) -> DataFrame:
    """The graph after another round."""
    links = graph.select("u", F.explode("nbrs").alias("n")).select(
        "u", "n.v", (-F.col("n.far")).cast("float").alias("s"), "n.fresh")
    hubs = links.groupBy("v").agg(
        F.ceil(F.count("*") / HUB_LINKS).cast("int").alias("salts"))
    ends = (
        nodes.select("node", "packed")
        .join(graph.select(
            F.col("u").alias("node"),
            F.when(F.size("nbrs") >= neighbours, -F.element_at("nbrs", -1)["far"])
            .otherwise(-2.0).cast("float").alias("bound")), "node")
        .join(hubs.withColumnRenamed("v", "node"), "node", "left")
        .withColumn("salts", F.coalesce("salts", F.lit(1)))
    )
    ends = cut_lineage(ends)
    near = ends.select(*[F.col(c).alias(f"v_{c}") for c in ends.columns])
    joined = (
        links.join(ends, links["u"] == ends["node"])
        .join(near, F.col("v") == F.col("v_node"))
    )
    side = lambda center, salt, role, end: F.struct(
        F.col(center).alias("center"), salt.cast("int").alias("salt"),
        F.lit(role).alias("role"), F.col(end + "node").alias("other"),
        F.col(end + "packed").alias("packed"), F.col(end + "bound").alias("bound"),
        F.col("fresh").alias("fresh"))
    rows = joined.select(F.explode(F.concat(
        F.transform(F.sequence(F.lit(0), F.col("salts") - 1), lambda i: side("u", i, 0, "v_")),
        F.array(side("v", F.pmod(F.xxhash64("u"), F.col("v_salts")), 1, "")),
    )).alias("r")).select("r.*")
    found = (
        rows.repartition(_parts(nodes, 2 * count * neighbours), "center", "salt")
        .sortWithinPartitions("center", "salt", "role")
        .mapInArrow(_round_links(neighbours), _LINKS)
    )
    before = links.select("u", "v", "s", F.lit(True).alias("old"))
    return cut_lineage(_best_links(
        before.unionByName(found.withColumn("old", F.lit(False))), neighbours,
        4 * count * neighbours))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each visit, the neighbours of the visited node that are not below the query's bound.

    Rows are sorted by node and role: the node's neighbours, then the queries that visit it.
    """
    for table in groups_in(batches, 1):
        u, role, query, bound = (
            _column(table, c).to_numpy() for c in ("u", "role", "query", "bound"))
        starts, flat = _lists(table, "ids")
        packs = _column(table, "packed")
        new = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
        ends = np.r_[new[1:], len(u)]
        who, sizes, ids, sims = [], [], [], []
        seen = (ends - new > 1) & (role[new] == 0)
        for a, b in zip(new[seen].tolist(), ends[seen].tolist()):
            near = flat[starts[a] : starts[a + 1]]
            own = _unpacked(packs[a].as_py(), len(near))
            found = unpacked(packs[a + 1 : b].to_pylist()) @ own.T
            x, y = np.nonzero(found >= bound[a + 1 : b, None])
            who.append(query[a + 1 : b])
            sizes.append(np.bincount(x, minlength=b - a - 1))
            ids.append(near[y])
            sims.append(found[x, y])
        if not who:
            continue
        sizes = np.concatenate(sizes)
        some = sizes > 0
        at = pa.array(np.r_[0, np.cumsum(sizes[some])], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(who)[some]),
             pa.ListArray.from_arrays(at, pa.array(np.concatenate(ids), pa.int64())),
             pa.ListArray.from_arrays(at, pa.array(np.concatenate(sims), pa.float32()))],
            names=["query", "ids", "sims"])


def _visited(beam: int, visits: int):
    """New beams of the queries from their old ones and what their visits met."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_in(batches, 1):
            query = _column(table, "query").to_numpy()
            role = _column(table, "role").to_numpy()
            vec = _column(table, "packed")
            starts, ids = _lists(table, "ids")
            _, sims = _lists(table, "sims")
            marks, visited = _lists(table, "visited")
            new = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
            out = []
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(query)]):
                if role[a]:
                    continue
                held = slice(starts[a], starts[a + 1])
                have, value = ids[held], sims[held]
                seen = visited[marks[a] : marks[a + 1]].copy()
                # The nodes just visited are the best that were not.
                met = slice(starts[a + 1], starts[b])
                more, at = np.unique(ids[met], return_index=True)
                fresh = ~np.isin(more, have)
                if fresh.any():
                    have = np.r_[have, more[fresh]]
                    value = np.r_[value, sims[met][at[fresh]]]
                    seen = np.r_[seen, np.zeros(np.count_nonzero(fresh), dtype=bool)]
                order = np.lexsort((have, -value))[:beam]
                have, value, seen = have[order], value[order], seen[order]
                todo = np.flatnonzero(~seen)[:visits]
                seen[todo] = True
                out.append((query[a], vec[a].as_py(), have, value, seen, have[todo]))
            if out:
                q, p, h, s, d, t = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(p, pa.binary()),
                     pa.array(h, pa.list_(pa.int64())), pa.array(s, pa.list_(pa.float32())),
                     pa.array([x.tolist() for x in d], pa.list_(pa.bool_())),
                     pa.array(t, pa.list_(pa.int64()))],
                    names=["query", "packed", "ids", "sims", "visited", "todo"])

    return rows


_BEAM = ("query long, packed binary, ids array<long>, sims array<float>, "
         "visited array<boolean>, todo array<long>")


def _next_state(
    state: DataFrame, inline: DataFrame, parts: int, beam: int, visits: int, left: int
) -> DataFrame:
    """The beams of all queries after a step of ``left`` visits."""
    lists = lambda kind: F.array().cast(f"array<{kind}>")
    worst = F.when(F.size("sims") >= beam, F.element_at("sims", -1)).otherwise(-2.0)
    going = state.select(
        F.explode("todo").alias("u"), F.lit(1).alias("role"), "query", "packed",
        worst.cast("float").alias("bound"), lists("long").alias("ids"))
    there = inline
    if left <= FEW_VISITS:
        there = there.join(F.broadcast(going.select("u").distinct()), "u", "left_semi")
    there = there.select(
        "u", F.lit(0).alias("role"), F.lit(-1).cast("long").alias("query"), "packed",
        F.lit(-2.0).cast("float").alias("bound"), "ids")
    met = (
        there.unionByName(going).repartition(parts, "u").sortWithinPartitions("u", "role")
        .mapInArrow(_met, "query long, ids array<long>, sims array<float>")
        .select("query", F.lit(1).alias("role"), F.lit(None).cast("binary").alias("packed"),
                "ids", "sims", lists("boolean").alias("visited"))
    )
    held = state.select("query", F.lit(0).alias("role"), "packed", "ids", "sims", "visited")
    return cut_lineage(
        held.unionByName(met).repartition(parts, "query")
        .sortWithinPartitions("query", "role").mapInArrow(_visited(beam, visits), _BEAM))


def _contenders(state: DataFrame, asked: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """query, node: the nodes of the beams that can hold one of the ``k`` best rows.

    A query's own rows are no results, so nodes with none but its id do not count; they are
    counted with the ``k``. No similarity of packed vectors is off by more than ``far``, the
    errors of the two and what rounding adds: what lies further below the last one that
    counts than twice that is no result.
    """
    top = nodes.agg(F.max("error").alias("e"), F.max(F.length("packed")).alias("n")).first()
    error, width = top["e"] or 0.0, top["n"] or 0
    far = error * (2 + error) + (width + 8) * 2.0 ** -22
    alone = nodes.where(F.size("members") == 1).select(
        F.element_at("members", 1).alias("query_id")).groupBy("query_id").agg(
        F.count("*").alias("own"))
    most = asked.join(alone, "query_id", "left").groupBy(F.col("node").alias("query")).agg(
        (F.lit(k) + F.coalesce(F.max("own"), F.lit(0))).cast("int").alias("most"))
    last = F.element_at("sims", F.least(F.size("sims"), F.col("most"))).cast("double")
    return state.select("query", "ids", "sims").join(most, "query").select(
        "query", F.explode(F.filter(F.arrays_zip("ids", "sims"), lambda x: (
            x["sims"] >= last - 2 * far))).alias("x")).select("query", F.col("x.ids").alias("node"))


def nearest(
    rows: DataFrame,
    asks: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    neighbours: int | None = None,
    beam: int | None = None,
    visits: int | None = None,
) -> DataFrame:
    """query_id, rank, id, score: the ``k`` nearest others of each row where ``asks`` holds.

    ``asks`` is a condition on the key. Widths not given follow from the number of vectors.
    """
    if k > 5:
        raise ValueError("A node keeps six rows, enough for five others")
    nodes = vector_nodes(rows, key, vector)
    usual = widths_for(nodes.count())
    neighbours, beam, visits = (
        own or wide for own, wide in zip((neighbours, beam, visits), usual))
    graph = neighbour_graph(nodes, neighbours)
    # The graph with its neighbours' vectors, which is all that a visit needs.
    near = graph.select("u", F.posexplode("nbrs").alias("at", "n")).select("u", "at", "n.v")
    inline = cut_lineage(
        near.join(nodes.select(F.col("node").alias("v"), "packed"), "v")
        .groupBy("u").agg(F.sort_array(F.collect_list(F.struct("at", "v", "packed"))).alias("n"))
        .select("u", F.col("n.v").alias("ids"), F.expr(
            "aggregate(n.packed, binary(''), (a, x) -> a || x)").alias("packed"))
    )
    del graph, near
    release(rows.sparkSession)
    # Queries of equal vectors search once: a query is a node.
    own = rows.where(asks).select(F.col(key).alias("query_id"),
                                  _scaled(F.col(vector).cast("array<double>")).alias("vec"))
    asked = cut_lineage(own.join(nodes.select("vec", "node"), "vec").select(
        "query_id", "node").distinct())
    state = nodes.join(asked.select("node").distinct(), "node").select(
        F.col("node").alias("query"), "packed", F.array("node").alias("ids"),
        F.array(F.lit(1.0).cast("float")).alias("sims"), F.array(F.lit(True)).alias("visited"),
        F.array("node").alias("todo"),
    )
    state = cut_lineage(state)
    parts = _parts(nodes)
    while left := state.agg(F.sum(F.size("todo"))).first()[0]:
        state = _next_state(state, inline, parts, beam, visits, left)
        release(rows.sparkSession)
    best = _contenders(state, asked, nodes, k)
    full = nodes.select("node", "vec", "members")
    scored = (
        best.join(full, "node")
        .join(full.select(F.col("node").alias("query"), F.col("vec").alias("_q")), "query")
        .select("query", "members", _cosine(F.col("_q"), F.col("vec")).alias("score"))
    )
    pairs = asked.join(scored, asked["node"] == scored["query"]).select(
        "query_id", "score", F.explode("members").alias("id")).where("id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return pairs.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")


def _cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
