"""Operators that look at one text at a time."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tableprofile.llm.compression import (
    CHUNK_BYTES,
    WHOLE_BANDS,
    Ratios,
    band_of,
    base_counts,
    compression_bands,
)
from tableprofile.llm.density import extract_main_text, main_text
from tableprofile.llm.languages import family_of, fit_languages, predict_language
from tableprofile.llm.packing import WordIds
from tableprofile.llm.pieces import Encoder, decode_pieces, encode_pieces, encoding_digest
from tableprofile.llm.queries import tokenizer_file
from tableprofile.llm.shared import fold_of, unused
from tableprofile.llm.toxicity import fit_toxicity, nn_pu_fit, score_toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "a b c a b c a b c", "é ü #$|", "x\x1cy\x85z",
    "one line\none line\n \none line", "🙂 " * 400, "word " * 20000,
]


def frame(spark, texts, extra="x"):
    rows = [(i, t, extra) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, _kept string")


def counts_by_hand(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1
        for k in range(3)
    }
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_base_counts(text):
    assert base_counts((text or "").encode()) == counts_by_hand(text)


def test_base_counts_of_random_texts():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab é\n\t#\x0b\x1c") for _ in range(rng.randrange(80)))
        assert base_counts(text.encode()) == counts_by_hand(text)


def test_bands_by_hand(spark):
    rng = random.Random(1)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randrange(1, 9))) for _ in range(900))
    noise = "".join(rng.choices("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJ +", k=9000))
    texts = [*ODD_TEXTS, prose, noise, "the same words again and again " * 400]
    rows = {r["doc_id"]: r for r in compression_bands(frame(spark, texts)).collect()}
    pack = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    for i, text in enumerate(texts):
        data, row = (text or "").encode(), rows[i]
        n, _, _, _, repeated = counts_by_hand(text)
        failed = n < 50 or 100 * repeated > 50 * n
        assert row["base_failed"] == failed
        if failed:
            assert not row["kept"]
            continue

        def out(part):
            band = band_of(WHOLE_BANDS, len(part))
            return not band.least <= len(part) / len(pack.compress(part)) <= band.most

        cut = [data[k : k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]
        bad = sum(len(c) for c in cut if out(c)) / len(data)
        assert row["kept"] == (not out(data) and bad <= 0.5)
    assert rows[len(ODD_TEXTS)]["kept"]


def test_ratio_of_nothing():
    assert Ratios().measure(b"") == (None, False, 0.0)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert compression_bands(empty).count() == 0
    assert encoding_digest(empty, tokenizer_file("piece_bpe_32k.model")).count() == 0
    machines = fit_languages(empty.withColumn("lang", F.lit("en")), F.lit(True))
    assert predict_language(empty, machines).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_main_text(pages).count() == 0


def test_clashing_columns(spark):
    df = frame(spark, ["word " * 60]).withColumn("_text", F.lit("mine"))
    own = unused("_", df.columns)
    row = compression_bands(df, keep=tuple(df.columns), prefix=own).first()
    assert (row["_text"], row["_kept"], row[f"{own}n_words"]) == ("mine", "x", 60)


# Suffix-array encoding.


@pytest.fixture(scope="module")
def reference():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))


def odd_strings(alphabet, n, most, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_encoding_equals_the_library(reference):
    texts = [
        "", " ", "  x ", "a", "Hello  world\n\n foo é🙂 a", "a\0b", "=" * 200, "ab" * 500,
        "the" * 100, "internationalization" * 20, "x" * 70,
    ] + odd_strings("abcdefghinorst     \n\t.,éü🙂Σ　中文ABC123__==--▁ﬁ①", 800, 120, 1)
    encoder = Encoder(tokenizer_file("piece_bpe_32k.model"))
    for text, found in zip(texts, encoder.encode(texts)):
        ids = np.frombuffer(found, "<u4").tolist()
        assert ids == reference.encode(text), text
        assert encoder.pieces.decode(ids) == reference.decode(ids), text


def test_encoding_rows(spark, reference):
    path = tokenizer_file("piece_bpe_32k.model")
    texts = [None, "", "Two words.", "Two words.", "long " * 30000]
    df = frame(spark, texts)
    got = {r["doc_id"]: r["ids"] for r in encode_pieces(df, path).collect()}
    assert got == {i: reference.encode(t or "") for i, t in enumerate(texts)}
    for row in encoding_digest(df, path).collect():
        ids = np.array(got[row["doc_id"]], dtype="<u4").tobytes()
        assert (row["n_ids"], row["ids_crc32"]) == (len(ids) // 4, zlib.crc32(ids))
        assert row["round_trip"]
    back = decode_pieces(encode_pieces(df, path), path).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {i: t or "" for i, t in enumerate(texts)}


# Words by lookup.


def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    plain, words = Tokenizer.from_file(path), WordIds(path)
    texts = [
        "", "  x ", "a<|endoftext|>B", "<|STARTOFTEXT|>", "Foo.Bar. bar, x., 1. it's. é. É,",
        "a,b .c ,, ... x.y. z,", "ꬰ क़ ǅ", "w" * 50 + " " + "w" * 51, "a$$$ b.%%% c'd$ 7$",
    ] + odd_strings("abcstvdreABCİΣσς   \n\t.,''éü🙂　中123__==-ﬁ①\x1c\x85\xa0$%é", 1500, 60, 2)
    for text, found in zip(texts, words.encode(texts)):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(found, "<u4").tolist() == ids, text


# Languages and toxicity.


def test_families():
    assert family_of("en") == family_of("de") == "germanic"
    assert family_of("xx") == "only xx"


def prose(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n))


SYLLABLES = {
    "en": ["the", "ing", "ough", "wh", "and"], "de": ["sch", "ung", "ein", "keit", "ver"],
    "fr": ["eau", "oux", "ment", "que", "tion"], "es": ["ción", "ado", "que", "rra", "ñas"],
}


def test_languages_held_out(spark):
    rng = random.Random(2)
    rows = [
        (i, prose(rng, SYLLABLES[name], rng.randrange(5, 60)), name)
        for i, name in enumerate(list(SYLLABLES) * 60)
    ]
    rows += [(1000, None, "en"), (1001, "123 !!", "en"), (1002, "the thing", None), (None, "der", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fold = fold_of(F.col("doc_id"), 4)
    machines = fit_languages(df, (fold >= 0) & (fold != 2))
    got = predict_language(df, machines, keep=("doc_id", "lang")).where("doc_id is not null")
    got = {r["doc_id"]: r for r in got.withColumn("held", fold == 2).collect()}
    held = [r for r in got.values() if r["held"] and r["doc_id"] < 1000]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert (got[1000]["lang_pred"], got[1000]["score"]) == ("und", 0.0)
    assert got[1001]["lang_pred"] == "und"
    assert got[1002]["lang_pred"] in SYLLABLES


def test_one_language(spark):
    df = spark.createDataFrame([(1, "abc abd", "xx"), (2, "zzz", None)],
                               "doc_id long, text string, lang string")
    got = predict_language(df, fit_languages(df, F.lit(True))).collect()
    assert {r["lang_pred"] for r in got} == {"xx"}


def test_non_negative_risk_separates():
    rng = np.random.default_rng(0)
    # As the method assumes, positives look like the positives among the unlabelled.
    positive = (rng.random((300, 6)) < 0.3).astype(np.float32)
    positive[:, 0] = 1
    unlabelled = (rng.random((2000, 6)) < 0.3).astype(np.float32)
    unlabelled[:, 0] = np.arange(2000) < 200
    w, b = nn_pu_fit(positive, unlabelled, 0.1)
    assert w[0] + b > 0 > b


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 8 == 0
        words = prose(rng, SYLLABLES["en"], 40).split()
        if bad:
            for _ in range(3):
                words[rng.randrange(40)] = "grubnok" + rng.choice(["a", "er", "ish", "s"])
        rows.append((i, " ".join(words), 1))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    rows += [(1000, None, 1), (1001, "", 1), (None, "grubnoks", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    fold = fold_of(F.col("doc_id"), 5)
    model = fit_toxicity(docs, marks, fold > 0)
    got = score_toxicity(docs, model).where("doc_id < 600").withColumn("held", fold == 0).collect()
    held = [r for r in got if r["held"]]
    assert np.mean([(r["predicted"] == 1) == (r["doc_id"] % 8 == 0) for r in held]) > 0.97
    whole = score_toxicity(docs, model)
    assert whole.count() == len(rows)
    assert whole.where("score between 0 and 1").count() == len(rows)
    assert {r["predicted"] for r in whole.where("doc_id >= 1000").collect()} == {0}


def test_toxicity_without_positives(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    got = score_toxicity(docs, fit_toxicity(docs, marks, F.lit(True))).collect()
    assert [(r["score"], r["predicted"]) for r in got] == [(0.0, 0), (0.0, 0)]


# Pages.

PAGE = """<html><head><title>x</title><script>var a="</p><p>no";</script></head><body>
<header class="site"><h1>Site</h1></header><nav><a href=/>Menu</a></nav><div class="ad">Buy</div>
<div id="main"><div class="post"><h2>Head &amp; line</h2>
<p>First paragraph with a <a href=x>link</a> and enough text to be the main part.<p>Second
 paragraph, <b>bold text never closed<ul><li>one<li>two</ul>
<div class="comments"><p>A reader says a great deal about it, much more than the page.</p></div>
</div><div class="sidebar"><ul><li><a>x</a></ul></div></div>
<form><input><p>Sign up</p></form><footer>End</footer>"""


def test_main_text():
    assert main_text(PAGE) == (
        "Head & line\nFirst paragraph with a link and enough text to be the main part.\n"
        "Second paragraph, bold text never closed\none\ntwo"
    )


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>x", "x"), ("<", "<"),
    ("<div><p>a</p><p>b  c</p></div>", "a\nb c"), ("<script>x", ""), ("</p></div>y", "y"),
    ("<p>a&lt;b&#233;</p>", "a<bé"), ("<article><p><b>only bold<br></article>", "only bold"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(main_text("<p>" + "word " * 100000)) == 499999


def sentences(n, size):
    """``n`` texts of ``size`` characters without spaces, each unlike the others."""
    return [f"{i:04d}" + "x" * (size - 4) for i in range(n)]


def tags(name, texts):
    return "".join(f"<{name}>{t}</{name}>" for t in texts)


LEADS, ITEMS = sentences(3, 425), sentences(100, 50)
PARTS = [[f"{k}{t}" for t in sentences(6, 300)] for k in "abc"]
CELLS = [[f"{i:03d}{k}{'y' * 16}" for k in "abcde"] for i in range(400)]
LINKS = "<div><ul>" + '<li><a href="/">Elsewhere on these pages</a></li>' * 20 + "</ul></div>"


@pytest.mark.parametrize("inside, blocks", [
    (tags("p", LEADS) + f"<ul>{tags('li', ITEMS)}</ul>", LEADS + ITEMS),
    (f"<ul>{tags('li', ITEMS)}</ul>" + tags("blockquote", LEADS), ITEMS + LEADS),
    (tags("section", [tags("p", p) for p in PARTS]), [t for p in PARTS for t in p]),
    (tags("p", LEADS) + tags("section", [tags("p", PARTS[0])]) + tags("pre", LEADS[:1]),
     LEADS + PARTS[0] + LEADS[:1]),
    (tags("p", LEADS) + f"<table><tbody>{tags('tr', [tags('td', r) for r in CELLS])}</tbody></table>",
     LEADS + [c for r in CELLS for c in r]),
    (tags("div", [tags("p", LEADS) + f"<ol>{tags('li', ITEMS)}</ol>", tags("p", PARTS[1])]),
     LEADS + ITEMS + PARTS[1]),
])
def test_parts_beside_the_best_node(inside, blocks):
    assert main_text(f"<body>{LINKS}<article>{inside}</article>{LINKS}").split("\n") == blocks


@pytest.mark.parametrize("wrapper", [
    "div class='content-sidebar-wrap'", "div class=has-sidebar", "div class='page with-comments'",
    "div id=page-no-header", "div class=hidden-print", "div class='related-story'",
    "div class='widget'", "div id=notice", "section role=search class=overlay", "form id=aspnetForm",
])
@pytest.mark.parametrize("holder", ["article", "main", "div", "div class=story"])
def test_names_do_not_take_the_article_along(wrapper, holder):
    page = (
        f"<body>{LINKS}<{wrapper}><{holder}>{tags('p', LEADS)}</{holder.split()[0]}>"
        f"<div class='sidebar'><p>{PARTS[0][0]}</p></div></{wrapper.split()[0]}>"
        f"<div class='cookie-notice'><p>{PARTS[1][0]}</p></div><form><p>{PARTS[2][0]}</p></form>"
    )
    assert main_text(page).split("\n") == LEADS


def test_a_long_advert_beside_a_short_article():
    page = f"<body><div class=ad>{LEADS[0]}</div><article><h1>Head</h1><p>Short.</article>"
    assert main_text(page) == "Head\nShort."


def test_a_heading_keeps_its_wrapper():
    page = f"<div class=banner><h1>Head</h1><p>{LEADS[0]}</p></div><p>{LEADS[1]}</p><p>{LEADS[2]}</p>"
    assert main_text(page).split("\n")[:2] == ["Head", LEADS[0]]


def test_page_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None)],
                                  "page_id long, url string, html string")
    rows = extract_main_text(pages).collect()
    assert len(rows) == 3
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_pages_of_the_tables_are_articles(spark):
    """All pages of the tables hold one article element: its blocks are the truth."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in extract_main_text(pages, keep=("html",)).collect():
        inside = re.search(r"<article>(.*?)</article>", row["html"], re.S).group(1)
        blocks = [
            " ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split())
            for b in re.split(r"</?(?:p|h1)>", inside)
        ]
        assert row["text"] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page", [
    "<a " * 100_000, '<a b="' * 60_000, "<b>" * 50_000 + "</i>" * 50_000,
    "<b>" * 40_000 + "<hr>" * 40_000, "<ul>" + "<b>" * 40_000 + "<li>" * 40_000,
    "<!--" * 100_000, "<p '" * 50_000 + '"' + ">" * 50_000,
])
def test_malformed_pages_take_linear_time(page):
    import time

    start = time.process_time()
    main_text(page)
    # Times are far from the minutes that a quadratic reader takes.
    assert time.process_time() - start < 20


def test_raw_elements_end_whatever_the_case():
    inside = "Some words of the page that stay where they are. " * 3
    page = f"<p>İ {inside}</p><SCRIPT>var x = '<p>';</Script ><p>{inside}</p>"
    assert main_text(page).count("Some words") == 6
    assert "var" not in main_text(page)


def test_odd_characters_have_the_ids_of_the_library():
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["a￾b", "￾", "x\0y ￾\0 z", "￿", "\0\0", "￾ ￾word"]
    found = Encoder(path).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [library.encode(t) for t in texts]
