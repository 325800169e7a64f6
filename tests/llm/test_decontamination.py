"""Benchmark decontamination against a slow search for windows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tableprofile.llm.decontamination import (
    Automaton,
    Matcher,
    decontaminate,
    find_benchmark,
    item_parts,
    packed_automaton,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def slow(docs, items, window=10, coverage=1.0):
    """Words, hit words and items of each text, by comparing every window."""
    rows = []
    for text in docs:
        own, hit, found = words(text), set(), set()
        for name, item in items:
            w = words(item)
            if not w:
                continue
            t = min(window, max(1, int(np.ceil(coverage * len(w)))))
            windows = {tuple(w[k : k + t]) for k in range(len(w) - t + 1)}
            for k in range(len(own) - t + 1):
                if tuple(own[k : k + t]) in windows:
                    hit.update(range(k, k + t))
                    if name is not None:
                        found.add(str(name))
        rows.append((len(own), len(hit), sorted(found)))
    return rows


def random_texts(seed, letters="abcd", n=60):
    rng = random.Random(seed)
    some = lambda low, high: " ".join(rng.choices(letters, k=rng.randint(low, high)))
    items = [(i, some(0, 14)) for i in range(25)] + [(3, some(5, 9)), (None, some(4, 12))]
    docs = [some(0, 80) for _ in range(n)]
    docs += [some(0, 9) + " " + (rng.choice(items)[1]).upper() + "; " + some(0, 9) for _ in range(n)]
    return [*docs, None, "", "...", "a"], items


@pytest.mark.parametrize("seed,window,coverage,block,part", [
    (1, 10, 1.0, 1 << 20, 1 << 20), (2, 4, 1.0, 40, 6), (3, 6, 0.5, 30, 8), (4, 3, 0.3, 1 << 20, 4),
])
def test_equals_slow_search(spark, seed, window, coverage, block, part):
    docs, items = random_texts(seed, "abcdefgh"[: 2 + seed])
    found = find_benchmark(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        window, coverage, block_words=block, part_words=part,
    ).orderBy("doc_id").collect()
    got = [(r["n_words"], r["n_hit"], r["items"]) for r in found]
    assert got == slow(docs, items, window, coverage)


def test_automaton_accepts_just_the_runs():
    rng = np.random.default_rng(0)
    for _ in range(30):
        own = [rng.integers(0, 3, rng.integers(1, 12)).tolist() for _ in range(4)]
        grown = Automaton()
        for item in own:
            grown.add(item)
        runs = {tuple(x[i:j]) for x in own for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
        # Paths from the start are the runs, and a state's runs differ by dropping words.
        paths, todo = set(), [((), 0)]
        while todo:
            run, state = todo.pop()
            for word, to in grown.next[state].items():
                longer = (*run, word)
                assert longer not in paths
                paths.add(longer)
                assert grown.length[grown.link[to]] < len(longer) <= grown.length[to]
                todo.append((longer, to))
        assert paths == runs


def test_slices_and_bytes(spark, monkeypatch):
    text = "Ärger — the QUICK brown fox, jumps\x00over the lazy dog_again 日本語 x" * 3
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame(
        [(7, "quick brown fox jumps over the lazy dog again 日本語")], "item_id long, text string")
    row = find_benchmark(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == slow([text], [(7, items.first()["text"])])[0]
    data = text.encode()
    for span in row["spans"]:
        cut = data[span["start"] : span["end"]].decode()
        assert cut.startswith("QUICK") and cut.endswith("日本語")


def test_matcher_streams_only_long_stretches():
    arrays = packed_automaton([(0, 3, [b"a", b"b", b"c"]), (1, 3, [b"c", b"d", b"a"])])
    matcher = Matcher(arrays)
    ids = np.array([matcher.words.get(w, -1) for w in [b"a", b"b", b"x", b"c", b"d", b"a", b"b", b"c"]])
    assert list(matcher.stretches(ids)) == [(3, 8)]


def test_removal(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [(1, f"Keep this. {item.title()}! And much more that nobody tests in any known benchmark é.", "n"),
         (2, item, "n"), (3, "clean text", "n"), (4, None, "n"), (5, "", "n")],
        "doc_id long, text string, n_hit string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = {r["doc_id"]: r for r in decontaminate(docs, items).collect()}
    assert left[1]["text"] == "Keep this. ! And much more that nobody tests in any known benchmark é."
    assert sorted(left) == [1, 3, 4, 5]  # the second is nothing but the item
    assert left[3]["text"] == "clean text" and left[4]["text"] is None
    assert left[1].asDict().keys() == {"doc_id", "text", "n_hit"}


def test_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "a b " * 200_000), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "b a b"), (2, None), (3, "...")], "item_id long, text string")
    assert {(r["doc_id"], r["n_words"], r["n_hit"]) for r in find_benchmark(docs, none).collect()} == {
        (1, 400_000, 0), (2, 0, 0)}
    rows = {r["doc_id"]: r for r in find_benchmark(docs, items).collect()}
    assert rows[1]["n_hit"] == 399_999 and rows[1]["items"] == ["1"]
    assert find_benchmark(docs.limit(0), items).count() == 0
    assert item_parts(none).count() == 0
