"""Operators that relate rows to each other."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tableprofile.llm import descent
from tableprofile.llm.chosen_path import (
    choose,
    overlaps,
    runs_for,
    sampled,
    shingles,
    similarity_classes,
)
from tableprofile.llm.components import connected_components
from tableprofile.llm.descent import nearest, neighbour_graph, vector_nodes, widths_for
from tableprofile.llm.differencing import difference, shard_documents
from tableprofile.llm.packing import best_fit, crossover, evolve, fill_of, pack_pieces, token_pieces
from tableprofile.llm.quotations import reply_conversations
from tableprofile.llm.queries import tokenizer_file
from tableprofile.llm.shared import join_hot, numbered

FOLDER = "/root/testdata/sf0.001"


def test_numbered_has_no_gaps(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("int").alias("g")).repartition(7)
    rows = numbered(df, ["g"], "at").collect()
    for g in (0, 1):
        got = sorted(r["at"] for r in rows if r["g"] == g)
        assert got == list(range(len(got)))


# Packing.


def pieces_of(spark, lengths):
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(lengths)]
    return spark.createDataFrame(
        rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


def check_packing(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packing_is_valid_and_tight(spark):
    rng = np.random.default_rng(1)
    lengths = np.r_[rng.integers(1, 2049, 700), np.full(20, 2048), np.full(50, 700)]
    packed = pack_pieces(pieces_of(spark, lengths), block_pieces=300)
    rows = packed.collect()
    assert len(rows) == len(lengths)
    assert check_packing(rows, 2048) <= 1.03 * lengths.sum() / 2048 + 3


def test_packing_small_tables(spark):
    assert pack_pieces(pieces_of(spark, [])).count() == 0
    assert check_packing(pack_pieces(pieces_of(spark, [2048])).collect(), 2048) == 1
    assert check_packing(pack_pieces(pieces_of(spark, [5] * 10)).collect(), 2048) == 1


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 100, 200))[::-1]
    parents = []
    for _ in range(2):
        bins = np.full(200, -1, dtype=np.int32)
        best_fit(lengths, rng.permutation(200), np.empty(0, np.int64), bins, 100)
        parents.append(bins)
    for _ in range(20):
        child = crossover(*parents, lengths, 100, rng)
        fill = fill_of(lengths, child)
        assert (child >= 0).all() and (fill > 0).all() and fill.max() <= 100
        assert fill.sum() == lengths.sum()


def test_evolution_never_gets_worse():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(20, 70, 120))[::-1]
    first = []
    for _ in range(4):
        bins = np.full(120, -1, dtype=np.int32)
        best_fit(lengths, rng.permutation(120), np.empty(0, np.int64), bins, 100)
        first.append(bins)
    last = evolve(list(first), lengths, 100, 20, rng)
    assert last[0].max() <= min(b.max() for b in first)


def test_pieces_cut_long_documents_only(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "word " * 5000), (3, "word"), (None, "a b")],
        "doc_id long, text string")
    rows = token_pieces(docs, tokenizer_file("word_bpe_49k.json")).collect()
    got = sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"]) for r in rows)
    assert got == [(0, 0, 0, 3), (1, 0, 0, 1), (2, 0, 0, 1), (3, 0, 0, 2), (3, 0, 0, 2048),
                   (3, 1, 2048, 2048), (3, 2, 4096, 905)]


# Shards.


def test_differencing_by_hand():
    # 8 7 6 5 4 in two: 8+6 against 7+5+4, the known result of the method.
    sums = np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    total, went = difference(sums)
    assert total.tolist() == [14, 16]
    assert sorted(np.bincount(went[:, 0], weights=[8, 7, 6, 5, 4]).tolist()) == [14, 16]


def test_differencing_sums_follow_the_shards():
    sums = np.random.default_rng(1).integers(0, 1000, (50, 6))
    total, went = difference(sums)
    by_shard = np.zeros(6, dtype=np.int64)
    for row, to in zip(sums, went):
        by_shard[to] += row
    assert (by_shard == total).all()
    assert total.max() - total.min() < 100


def test_shards(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(1, 400) + str(i % 900)) for i in range(1200)]
    rows += [(5000 + i, "copy of one text " * 9) for i in range(60)]
    rows += [(6000, None), (6001, ""), (None, "no id"), (7, "seven again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x"))
    got = shard_documents(docs).toPandas()
    assert len(got) == len(rows)
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() < 0.02 * sums.mean()
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert got.groupby("text_crc32")["shard"].nunique().max() == 1
    assert got[got.doc_id == 6000]["size"].item() == 8
    assert set(got["law"]) == {"bytes"}


def test_shards_over_levels(spark):
    from tableprofile.llm.differencing import balanced_shards

    rows = spark.range(3000).select("id", (F.col("id") % 97 + 1).alias("size"))
    got = balanced_shards(rows, "id", "size", shards=5, block_groups=100)
    sums = got.groupBy("shard").agg(F.sum("size").alias("s")).toPandas()["s"]
    assert got.count() == 3000 and sums.max() - sums.min() <= 0.001 * sums.mean()


def test_shards_beside_a_heavy_group(spark):
    """One group of four fifths of a shard's part, one that is larger than a shard."""
    from tableprofile.llm.differencing import balanced_shards

    sizes = [10 + i % 91 for i in range(6000)]
    part = sum(sizes) / 5
    for heavy in (0.8 * part, 3 * part):
        rows = spark.createDataFrame([*enumerate(sizes), (-1, int(heavy))], "id long, size long")
        got = balanced_shards(rows, "id", "size", shards=6, block_groups=200)
        sums = got.groupBy("shard").agg(F.sum("size").alias("s")).toPandas()["s"].sort_values()
        others = sums.iloc[:-1] if heavy > part else sums
        assert others.max() - others.min() <= 0.001 * others.mean()


def test_no_shards(spark):
    assert shard_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Similarity join.


def brute_classes(texts, threshold=0.8):
    sets = [set(shingles(t).tolist()) for t in texts]
    links, root = [0] * len(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            common = len(sets[a] & sets[b])
            if common and common >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], links


def near_texts(seed, groups, most, words=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    shared = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(words)]
        for _ in range(rng.randrange(1, most)):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own) + (" " + shared if rng.random() < 0.5 else ""))
    return texts


@pytest.mark.parametrize("small, chunk", [(256, 256), (8, 5)])
def test_classes_equal_brute_force(spark, small, chunk):
    """With small buckets every text goes through bands, splits and chunk pairs."""
    texts = near_texts(5, 25, 9) + near_texts(6, 1, 60) + ["short one", "short one", "a b c d e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = similarity_classes(docs, small_bucket=small, chunk=chunk).orderBy("doc_id").collect()
    classes, links = brute_classes(texts)
    assert [r["class_id"] for r in got] == classes
    assert [r["n_links"] for r in got] == links


def test_classes_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "same text here"), (4, "same text here"), (4, "same text here"),
            (None, "same text here"), (5, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sid", F.lit(1))
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"])
                 for r in similarity_classes(docs).collect())
    assert got == [(0, 3, 3), (1, 1, 0), (2, 2, 0), (3, 3, 3), (4, 3, 3), (4, 3, 3), (5, 5, 0)]
    assert similarity_classes(docs.limit(0)).count() == 0


def test_overlaps_both_ways():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30).astype(np.uint32)) for _ in range(40)]
    a, b = np.triu_indices(40, 1)
    want = [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b)]
    assert overlaps(sets, a, b).tolist() == want
    assert overlaps(sets, a[:50], b[:50]).tolist() == want[:50]


def test_runs_reach_the_recall():
    assert runs_for(0.9999, 0.8, 3.0) == 4
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(300):
        tokens = rng.integers(0, 2**63, 450).astype(np.uint64)
        pools = [sampled(t, 64) for t in (tokens[:400], tokens[50:])]  # similarity 0.78
        picks = [[choose(p, 3 / 64, 100 + r) for r in range(4)] for p in pools]
        missed += not any(len(np.intersect1d(x, y)) for x, y in zip(*picks))
    assert missed <= 2


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    edges += [(3000, i) for i in range(2000, 4000, 2)] + [(i, 9000) for i in range(5000, 6000)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["root"] for r in got.collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_join_of_hot_keys_equals_a_join(spark):
    many = spark.createDataFrame(
        [(i, 7 if i % 3 else i, str(i)) for i in range(6000)] + [(-1, None, "n")],
        "id long, key long, _hot string").repartition(5)
    few = spark.createDataFrame([(k, k * 2) for k in range(5000)], "key long, twice long")
    counts = many.groupBy("key").count().where("count > 100").select("key")
    hot = few.join(counts, "key", "left_semi")
    want = sorted(map(tuple, many.join(few, "key").select("id", "key", "_hot", "twice").collect()))
    got = join_hot(many, few, hot, "key")
    assert sorted(map(tuple, got.select("id", "key", "_hot", "twice").collect())) == want
    none = join_hot(many, few, hot.limit(0), "key")
    assert sorted(map(tuple, none.select("id", "key", "_hot", "twice").collect())) == want


# Neighbours.


def test_nearest_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = nearest(df, F.col("vec_id") % 5 == 0).toPandas()
    rows = df.toPandas()
    ids = rows["vec_id"].to_numpy()
    x = np.stack(rows["embedding"].to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    asked = np.flatnonzero(ids % 5 == 0)
    assert len(found) == 5 * len(asked)
    for i in asked:
        sims = x @ x[i]
        sims[i] = -2
        want = set(ids[np.argsort(-sims)[:5]])
        own = found[found.query_id == ids[i]].sort_values("rank")
        hits += len(want & set(own["vec_id"]))
        at = {v: k for k, v in enumerate(ids)}
        assert np.allclose(own["score"], [sims[at[v]] for v in own["vec_id"]], atol=1e-12)
    assert hits / (5 * len(asked)) >= 0.95


def normal_vectors(spark, n, width):
    x = np.random.default_rng(5).normal(size=(n, width))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_search_goes_on_until_the_beam_is_visited(spark):
    x, df = normal_vectors(spark, 1500, 12)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = nearest(df, F.col("vec_id") < 40, neighbours=6, beam=60, visits=3).toPandas()
    hits = 0
    for i in range(40):
        sims = x @ x[i]
        sims[i] = -2
        hits += len(set(np.argsort(-sims)[:5]) & set(found[found.query_id == i]["vec_id"]))
    assert hits / 200 >= 0.95


def test_rounds_go_on_until_few_links_are_new(spark):
    _, df = normal_vectors(spark, 1500, 12)
    graph = neighbour_graph(vector_nodes(df, "vec_id", "embedding"), 6, leaf=16, tables=1)
    new = graph.agg(F.sum(F.size(F.filter("nbrs", lambda n: n["fresh"])))).first()[0]
    assert new <= 0.02 * 6 * 1500


def test_widths_grow_with_the_vectors():
    assert widths_for(0) == widths_for(500) == widths_for(51282) == (26, 400, 64)
    wide = [widths_for(51282 * 4**k) for k in range(4)]
    assert all(a < b for one, two in zip(wide, wide[1:]) for a, b in zip(one, two))


def test_nearest_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None),
            (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (None, [1.0, 1.0]),
            (8, [1.0, 2.0, 3.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(df, F.col("vec_id").isin(0, 5)).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got] == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0)]
    assert nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_nearest_of_extreme_numbers(spark):
    """Cosines of tiny and huge vectors equal those of the same directions of usual size."""
    plain = [[1.0, 1.0], [10.0, 1.0], [1.0, 0.0], [-3.0, 7.0], [1.0, 9.0], [0.0, -2.0]]
    by = [1e-200, 1e199, 5e-324, 1e-300, 1.0, 8e307]
    rows = [(i, [x * f for x in v]) for i, (v, f) in enumerate(zip(plain, by))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, F.col("vec_id") >= 0).orderBy("query_id", "rank").collect()
    unit = np.array(plain) / np.linalg.norm(plain, axis=1, keepdims=True)
    for q in range(len(plain)):
        cosines = unit @ unit[q]
        order = sorted((i for i in range(len(plain)) if i != q), key=lambda i: (-cosines[i], i))
        own = [r for r in got if r["query_id"] == q]
        assert [r["vec_id"] for r in own] == order
        assert [r["score"] for r in own] == pytest.approx([cosines[i] for i in order], abs=1e-12)


def test_nearest_of_many_copies(spark):
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(200)] + [(200 + i, [1.0, float(i), 2.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(df, F.col("vec_id").isin(3, 150)).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 4, 5, 0, 1, 2, 3, 4]


# Quotations.


def test_replies(spark):
    rows = [
        (1, 0, "Hello there big world"),
        (1, 1, "Reply one\n\nOn Monday X wrote:\n> hello  there\n> big world"),
        (1, 2, "third text\n> Reply one\n>> Hello there big world\nmore text"),
        (1, 3, "x\n> third text\n> > Reply one\n> more text of others"),
        (1, 4, ""), (2, 0, None), (2, 1, "> Hello there big world"), (None, 5, "a"), (1, None, "b"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn(
        "parent", F.lit("clash"))
    got = {(r["conv_id"], r["turn"]): r for r in reply_conversations(df).collect()}
    assert len(got) == len(rows)
    place = lambda c, t: tuple(
        got[c, t][x] for x in ("parent", "root", "reply_depth", "reply_order", "text"))
    assert place(1, 0) == (None, 0, 0, 0, "Hello there big world")
    assert place(1, 1) == (0, 0, 1, 1, "Reply one")
    assert place(1, 2) == (1, 0, 2, 2, "third text\nmore text")
    assert place(1, 3) == (2, 0, 3, 3, "x")
    assert place(1, 4) == (None, 4, 0, 0, "")
    assert place(2, 1) == (None, 1, 0, 0, "")
    assert place(None, 5) == (None, 5, 0, 0, "a")
    assert (got[1, 3]["n_quotes"], got[1, 3]["n_linked"]) == (3, 2)


def test_own_lines_that_announce_nothing_stay(spark):
    rows = [
        (0, "On Monday my sister wrote:\nthree long letters"),
        (1, "On Monday X wrote:\nOn Tuesday Y wrote:\n\n> three long letters\nOn Sunday he wrote:"),
        (2, "> three long letters\nEl lunes escribió:"),
        (3, "On Monday X wrote:"), (4, "On Monday X wrote:\n> a\n>> b\n> c\nOn it Z wrote:\n> d"),
    ]
    got = reply_conversations(spark.createDataFrame(rows, "turn long, text string"), scope=())
    assert {r["turn"]: r["text"] for r in got.collect()} == {
        0: "On Monday my sister wrote:\nthree long letters",
        1: "On Monday X wrote:\n\nOn Sunday he wrote:",
        2: "El lunes escribió:",
        3: "On Monday X wrote:", 4: "",
    }


def test_replies_without_scope(spark):
    df = spark.createDataFrame([(0, "some first words"), (9, "yes\n> some first words")],
                               "turn long, text string")
    got = reply_conversations(df, scope=()).orderBy("turn").collect()
    assert [(r["root"], r["reply_depth"]) for r in got] == [(0, 0), (0, 1)]
    assert reply_conversations(df.limit(0), scope=()).count() == 0


def test_long_chain(spark):
    rows = [(1, i, f"message number {i}" + (f"\n> message number {i - 1}" if i else ""))
            for i in range(300)]
    got = reply_conversations(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    assert sorted((r["turn"], r["reply_depth"], r["reply_order"]) for r in got.collect()) == [
        (i, i, i) for i in range(300)]


# The pipeline.


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("_kept", F.lit("mine"))
    first = corpus_pipeline.language_id(spark, docs, FOLDER)
    assert first.columns == docs.columns and first.count() == docs.count()
    second = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    assert second.columns == docs.columns and 0 < second.count() < docs.count()
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    classes, _ = brute_classes([r["text"] for r in rows])
    leads = {rows[c]["doc_id"] for c in classes}
    third = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert third.columns == docs.columns
    assert {r["doc_id"] for r in third.select("doc_id").collect()} == leads
    last = corpus_pipeline.best_fit_packing(spark, third, FOLDER)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == leads


def test_pipeline_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, "word one two"), (None, "word one two"), (3, "word one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    assert corpus_pipeline.language_id(spark, docs, FOLDER).count() == 3
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER).select("doc_id", "text").collect()
    assert len([r for r in kept if r["doc_id"] == 2]) == 1
    assert len([r for r in kept if r["doc_id"] is None]) == 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_one_document_of_each_group(spark):
    words = [f"word{i}" for i in range(60)]
    x, near, y = " ".join(words), " ".join([*words, "more"]), " ".join(reversed(words))
    z = " ".join(words[::2])
    rows = [(1, x), (5, near), (5, y), (None, z), (None, z), (7, z), (9, ""), (9, None), (6, y)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("source", F.concat(F.lit("of "), F.coalesce("text", F.lit("none"))))
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    got = {(r["doc_id"], r["text"], r["source"]) for r in kept.collect()}
    want = [(1, x), (5, y), (None, z), (9, ""), (9, None)]
    assert got == {(i, t, "of " + ("none" if t is None else t)) for i, t in want}
    assert kept.count() == len(want)


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 50


def test_searches_compare_only_contenders_again_and_release_files(spark, monkeypatch):
    """Ids with many vectors are no exception: none of them are results of their own."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 16))
    x[:4] = x[0] + rng.normal(size=(4, 16)) / 100
    ids = np.r_[np.zeros(4, int), np.arange(4, 400)]
    df = spark.createDataFrame(
        [(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    calls, again = Counter(), descent._contenders
    for name in ("release", "_next_graph", "_next_state"):
        monkeypatch.setattr(descent, name, lambda *a, f=getattr(descent, name), n=name: (
            calls.update([n]), f(*a))[1])

    def counted(*args):
        found = again(*args).localCheckpoint()
        calls["again"] += found.count()
        return found

    monkeypatch.setattr(descent, "_contenders", counted)
    found = nearest(df, F.col("vec_id") < 20, neighbours=10, beam=200, visits=40).toPandas()
    assert calls["release"] >= calls["_next_graph"] + calls["_next_state"] > 2
    assert calls["again"] < 20 * 40
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for query in (0, *range(4, 20)):
        sims = x[ids == query] @ x[ids != query].T
        best = sorted((-s, i) for row in sims for s, i in zip(row, ids[ids != query]))[:5]
        own = found[found.query_id == query].sort_values("rank")
        assert own["vec_id"].tolist() == [i for _, i in best]
        assert np.allclose(own["score"], [-s for s, _ in best], atol=1e-12)
