"""Alignment of two tokenizers against a slow alignment of whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

from tableprofile.llm.alignment import (
    ByteTokens,
    PieceTokens,
    aligned_block,
    align_tokenizers,
    aligned_groups,
    parts_of,
)
from tableprofile.llm.queries import tokenizer_file

FIRST, SECOND = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = [
    None, "", " ", "a", "  two  spaces ", "tab\there\n\nnew", "a▁b", "a ▁ b", "<|endoftext|> </s> <0x41>",
    "naïve façade — “quoted” …", "日本語のテキスト", "👩‍👩‍👧 ok", "\x00 nul", "\x1c x \x1f y", "x" * 500,
    " lead", "trail ", "1234567890 12 3", "don't we'll", "￾ ￿", "é é",
]


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def slow_groups(text, first, second):
    """Groups of (ids of the first, ids of the second), from the libraries themselves."""
    if not text:
        return []
    of = letters()
    a = [(i, bytes(of[c] for c in first.id_to_token(i)))
         for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if second.is_byte(i)
                  else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    ends = []
    for side in (a, b):
        at, own = 0, []
        for _, x in side:
            at += len(x)
            own.append(at)
        ends.append(own)
    cuts = set(ends[0]) & set(ends[1])
    groups = [[[]], [[]]]
    for own, side, at in zip(groups, (a, b), ends):
        for (i, _), end in zip(side, at):
            own[-1].append(i)
            if end in cuts:
                own.append([])
    return list(zip(groups[0][:-1], groups[1][:-1]))


def slow_alignment(texts):
    first, second = libraries()
    every = [slow_groups(t, first, second) for t in texts]
    held, links = Counter(), []
    for groups in every:
        own = Counter((x, y) for a, b in groups for x in a for y in b)
        links.append(own)
        held.update(own.keys())
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    rows = []
    for groups, own in zip(every, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
            sum(own.values()), sum(n for p, n in own.items() if held[p] == highest[p[0]]),
            sum(n * held[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return rows, held


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_equals_slow_alignment(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = ODD * 2 + [r["text"] for r in table.orderBy("doc_id").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = align_tokenizers(docs, FIRST, SECOND, block_bytes=20_000)
    rows = {r["doc_id"]: tuple(r[c] for c in FIGURES) for r in found.documents.collect()}
    wanted, held = slow_alignment(texts)
    assert len(rows) == len(texts)
    for i, row in enumerate(wanted):
        assert rows[i] == row, (i, texts[i])
    assert {(r["a"], r["b"]): r["documents"] for r in found.pairs.collect()} == dict(held)


def test_random_texts_in_parts():
    random.seed(4)
    first, second = libraries()
    a, b = ByteTokens(FIRST), PieceTokens(SECOND)
    letters = "ab  \n.,'日é▁0\t\x1c　-"
    for _ in range(300):
        text = "".join(random.choices(letters, k=random.randint(1, 60)))
        whole = parts_of(text)
        assert " ".join(whole) == text
        assert [i for x in a.encode(whole) for i in x] == first.encode(
            " " + text, add_special_tokens=False).ids, repr(text)
        assert [i for x in b.encode(whole) for i in x] == second.encode(text), repr(text)


def test_vocabulary_without_ranks_uses_the_library(monkeypatch):
    slow = ByteTokens(FIRST)
    texts = [t for t in ODD if t]
    quick = slow.encode(texts)
    from tokenizers import Tokenizer

    slow.fast, slow.slow = None, Tokenizer.from_file(FIRST)
    slow.slow.encode_special_tokens = True
    assert slow.encode(texts) == quick


def test_links_in_slices():
    a, b = ByteTokens(FIRST), PieceTokens(SECOND)
    texts = [t for t in ODD if t] + ["日本語の" * 40]
    parts = aligned_block(texts, a, b).parts
    whole = parts.links(len(b.bytes))
    cut = parts.links(len(b.bytes), joined=7)
    order = lambda t: sorted(zip(*(t[c].to_pylist() for c in ("part", "pair", "links"))))
    assert order(whole) == order(cut)


def test_groups_and_odd_columns(spark):
    docs = spark.createDataFrame(
        [(1, "x", "hello world"), (None, "y", None), (1, "z", "hello")],
        "group long, block string, text string")
    keep = ("group", "block")
    found = align_tokenizers(docs, FIRST, SECOND, keep=keep).documents
    assert found.columns == [*keep, *FIGURES]
    assert {(r["group"], r["block"]): r["n_a"] for r in found.collect()} == {
        (1, "x"): 2, (None, "y"): 0, (1, "z"): 1}
    groups = aligned_groups(docs, FIRST, SECOND, keep=keep)
    assert groups.columns == [*keep, "_group", "a", "b"]
    assert groups.groupBy("block").count().orderBy("block").collect()[0]["count"] == 2
    assert align_tokenizers(docs.limit(0), FIRST, SECOND, keep=keep).documents.count() == 0


def test_long_texts(spark):
    texts = ["word " * 30_000, "x" * 30_000, "日" * 20_000, " " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = align_tokenizers(docs, FIRST, SECOND).documents.orderBy("doc_id").collect()
    first, second = libraries()
    for row, text in zip(rows, texts):
        groups = slow_groups(text, first, second)
        assert row["n_groups"] == len(groups)
        assert row["n_links"] == sum(len(a) * len(b) for a, b in groups)
