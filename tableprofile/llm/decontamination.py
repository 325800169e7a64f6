"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of letters, digits and characters beyond ASCII; A-Z are lowered. The
automaton accepts every run of words of every item. Streaming a document through it gives,
at each word, the state of the longest run of item words that ends there; where nothing
goes on, the state falls back along suffix links. A state tells which items hold its run,
so a match counts as soon as it reaches the limit of an item: ``window`` words, or the
share ``coverage`` of the item's words where that is fewer. All words of such a match are
hit, and spans of hit words can be cut out of the text; a document too much of which is
hit can be dropped.

Most words of a document cannot be part of a match: the automaton has no path over them.
Numpy finds the stretches all of whose neighbouring words stand side by side in some item,
and only stretches as long as the shortest limit are streamed.

Items are spread over blocks of about ``block_words`` words, long items in overlapping
parts, and Spark tasks build an automaton for each block. A block is packed into arrays and
broadcast by itself, so its size bounds what the driver and a worker hold at once; documents
are scanned once, whatever the number of blocks.

Null and empty texts have no words and no hits; items without a word match nothing. Texts of
any length go through whole, in slices. Repeated documents get a row each; an item id on
several rows counts once, and an item without an id marks words but is not listed.
Without items nothing is hit; without documents there are no rows. Kept columns may have any
names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.llm.shared import by_size, unused

WINDOW = 10
COVERAGE = 1.0
BLOCK_WORDS = 200_000
PART_WORDS = 20_000
SLICE_BYTES = 1 << 20

# Everything that is not a word becomes a space; bytes from 0x80 on are parts of characters.
_PLAIN = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of a slice of it each."""
    start = 0
    while start < len(text):
        stop = start + SLICE_BYTES
        if stop < len(text):
            # A slice ends after a byte that is in no word.
            while stop < len(text) and _PLAIN[text[stop - 1]] != 32:
                stop += 1
        yield text[start:stop].translate(_PLAIN).split()
        start = stop


class Automaton:
    """A generalised suffix automaton of word ids, grown item by item."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of p's run and the word; q is cut in two where it holds longer runs."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, word: int) -> int:
        """The state of an item's beginning, one word longer."""
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.next[p][word])
        return new

    def add(self, words: Sequence[int]) -> None:
        state = 0
        for word in words:
            state = self.extend(state, word)


def packed_automaton(parts: Sequence[tuple[int, int, list[bytes]]]) -> dict:
    """Arrays of the automaton of some (item number, limit, words)."""
    vocabulary: dict[bytes, int] = {}
    coded = [[vocabulary.setdefault(w, len(vocabulary)) for w in words] for *_, words in parts]
    grown = Automaton()
    for own in coded:
        grown.add(own)
    # Limits that are reached in a state, with the items; a state holds one set of them.
    reached: dict[int, dict[int, set[int]]] = {}
    for (item, limit, _), own in zip(parts, coded):
        state = 0
        for at, word in enumerate(own, 1):
            state = grown.next[state][word]
            if at >= limit:
                held = state
                while grown.length[grown.link[held]] >= limit:
                    held = grown.link[held]
                reached.setdefault(held, {}).setdefault(limit, set()).add(item)
    marked = sorted(reached)
    first_limit = np.cumsum([0, *(len(reached[s]) for s in marked)])
    limits = [(t, sorted(reached[s][t])) for s in marked for t in sorted(reached[s])]
    # The nearest state with limits, from a state upwards.
    number = {s: i for i, s in enumerate(marked)}
    nearest = np.full(len(grown.link), -1, dtype=np.int32)
    for state in np.argsort(np.array(grown.length), kind="stable").tolist():
        own = number.get(state, -1)
        above = nearest[grown.link[state]] if state else -1
        nearest[state] = own if own >= 0 else above
    width = len(vocabulary)
    beside = {a * width + b for own in coded for a, b in zip(own, own[1:])}
    steps = [sorted(x.items()) for x in grown.next]
    return {
        "words": vocabulary,
        "beside": np.array(sorted(beside), dtype=np.int64),
        "first": np.cumsum([0, *map(len, steps)]).astype(np.int32),
        "word": np.array([w for x in steps for w, _ in x], dtype=np.int32),
        "to": np.array([t for x in steps for _, t in x], dtype=np.int32),
        "link": np.array(grown.link, dtype=np.int32),
        "length": np.array(grown.length, dtype=np.int32),
        "nearest": nearest,
        "marked": np.array(marked, dtype=np.int32),
        "first_limit": first_limit.astype(np.int32),
        "limit": np.array([t for t, _ in limits], dtype=np.int32),
        "first_item": np.cumsum([0, *(len(x) for _, x in limits)]).astype(np.int32),
        "item": np.array([i for _, x in limits for i in x], dtype=np.int64),
        "least": min((limit for _, limit, _ in parts), default=1),
    }


class Matcher:
    """Streams documents through a packed automaton."""

    def __init__(self, arrays: dict):
        self.words, self.beside = arrays["words"], arrays["beside"]
        self.least = arrays["least"]
        # Views give plain integers without copying.
        for name in ("first", "word", "to", "link", "length", "nearest", "marked",
                     "first_limit", "limit", "first_item", "item"):
            setattr(self, name, memoryview(arrays[name]))

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words that stand side by side in items, long enough for a match."""
        known = ids >= 0
        joined = known[:-1] & known[1:]
        at = np.flatnonzero(joined)
        codes = ids[at] * len(self.words) + ids[at + 1]
        place = np.searchsorted(self.beside, codes)
        place[place == len(self.beside)] = 0
        joined[at] = self.beside[place] == codes if len(self.beside) else False
        starts = np.flatnonzero(known & ~np.r_[False, joined])
        stops = np.flatnonzero(known & ~np.r_[joined, False]) + 1
        enough = stops - starts >= self.least
        yield from zip(starts[enough].tolist(), stops[enough].tolist())

    def match(self, ids: np.ndarray, hit: np.ndarray, items: set[int]) -> None:
        """Mark the words of matches and collect the items, in place."""
        if not len(ids):
            return
        first, word, to, link, length = self.first, self.word, self.to, self.link, self.length
        taken: set[tuple[int, int]] = set()
        for start, stop in self.stretches(ids):
            state = matched = 0
            covered = start
            for at, w in enumerate(ids[start:stop].tolist(), start + 1):
                while True:
                    low, high = first[state], first[state + 1]
                    place = bisect_left(word, w, low, high)
                    if place < high and word[place] == w:
                        state = to[place]
                        matched += 1
                        break
                    state = link[state]
                    matched = length[state]
                if matched < self.least:
                    continue
                span = self._reached(state, matched, items, taken)
                if span:
                    hit[max(covered, at - span) : at] = True
                    covered = at if at - span <= covered else covered

    def _reached(self, state: int, matched: int, items: set[int], taken: set) -> int:
        """The longest limit reached here (0 for none); its items and those above are added."""
        longest = 0
        mark = self.nearest[state]
        while mark >= 0:
            own = self.marked[mark]
            low, high = self.first_limit[mark], self.first_limit[mark + 1]
            while high > low and self.limit[high - 1] > matched:
                high -= 1
            if high > low:
                # Runs get shorter on the way up, so the first limit found is the longest.
                longest = longest or self.limit[high - 1]
                if (mark, high) in taken:
                    return longest  # all that lies above was taken with it
                taken.add((mark, high))
                items.update(self.item[self.first_item[low] : self.first_item[high]].tolist())
            up = self.link[own]
            mark = self.nearest[up] if up >= 0 else -1
        return longest


def item_parts(
    items: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    item: str = "item_id",
    text: str = "text",
    part_words: int = PART_WORDS,
) -> DataFrame:
    """The words of the items in parts ``(item, part, limit, n_words, words)``.

    Parts of an item overlap by one word less than its limit, so they hold all its runs
    of that length.
    """
    chosen = items.select(F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = []
            for name, data in zip(df["item"], df["text"]):
                words = [w for own in words_of(data or b"") for w in own]
                if not words:
                    continue
                limit = min(window, max(1, math.ceil(coverage * len(words))))
                step = max(part_words, limit)
                for part, at in enumerate(range(0, max(1, len(words) - limit + 1), step)):
                    own = words[at : at + step + limit - 1]
                    rows.append((name, part, limit, len(own), b" ".join(own)))
            yield pd.DataFrame(rows, columns=["item", "part", "limit", "n_words", "words"])

    return chosen.mapInPandas(
        parts, "item string, part long, limit int, n_words long, words binary")


def automata(
    parts: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per block of items: the automaton and the item names, packed."""
    import pickle

    held = cut_lineage(parts.dropDuplicates(["item", "part", "limit", "words"]))
    total = held.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(total / block_words))
    dealt = held.withColumn(
        "block", F.pmod(F.xxhash64("item", "part", "words"), F.lit(blocks)).cast("int"))

    def build(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        names = sorted(df["item"].dropna().unique().tolist())
        number = {name: i for i, name in enumerate(names)}
        rows = sorted(zip(df["item"].map(lambda i: number.get(i, -1)), df["limit"], df["words"]))
        arrays = packed_automaton([(i, t, w.split()) for i, t, w in rows])
        return pd.DataFrame({"block": [key[0]], "packed": [pickle.dumps((arrays, names))]})

    return cut_lineage(dealt.groupBy("block").applyInPandas(build, "block int, packed binary"))


def find_benchmark(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    item: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
    part_words: int = PART_WORDS,
    prefix: str = "",
) -> DataFrame:
    """The hits of each document: kept columns, words, hit words, item ids and spans.

    Spans are the longest stretches of hit words, as byte offsets of the text in UTF-8; in
    front of their names, the new columns carry ``prefix``. Item ids are texts in order.
    """
    spark = docs.sparkSession
    built = automata(item_parts(items, window, coverage, item, item_text, part_words), block_words)
    # One block is on the driver at a time, and broadcast by itself.
    sent: list[Broadcast] = [
        spark.sparkContext.broadcast(bytes(row["packed"])) for row in built.toLocalIterator()]
    chosen = docs.select(*keep, F.col(text).cast("binary").alias(unused("_text", keep)))
    found = T._parse_datatype_string(FOUND).fields
    schema = T.StructType([
        *[docs.schema[c] for c in keep],
        *[T.StructField(prefix + f.name, f.dataType) for f in found]])
    names = schema.names

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Opened(sent)
        for batch in batches:
            for own, texts in by_size(batch):
                hits = _hits(texts, opened)
                kept = [own.column(i) for i in range(len(keep))]
                columns = [
                    pa.array([len(hit) for hit, _ in hits], pa.int64()),
                    pa.array([int(hit.sum()) for hit, _ in hits], pa.int64()),
                    pa.array([sorted(x) for _, x in hits], pa.list_(pa.string())),
                    pa.array(
                        [_spans(data, hit) for data, (hit, _) in zip(texts, hits)],
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=names)

    return chosen.mapInArrow(rows, schema)


class _Opened:
    """The automata one after the other; a single one stays open."""

    def __init__(self, sent: Sequence[Broadcast]):
        self.sent = sent
        self.only: tuple[Matcher, list[str]] | None = None

    def __iter__(self) -> Iterator[tuple[Matcher, list[str]]]:
        import pickle

        for broadcast in self.sent:
            if self.only is not None:
                yield self.only
                continue
            arrays, names = pickle.loads(broadcast.value)
            opened = Matcher(arrays), names
            if len(self.sent) == 1:
                self.only = opened
            else:
                broadcast.__dict__.pop("_value", None)  # read from disk again when needed
            yield opened


def _hits(texts: Sequence[bytes | None], opened: _Opened) -> list[tuple[np.ndarray, set[str]]]:
    """Marks of hit words and the item names of each text."""
    found: list[tuple[np.ndarray, set[str]]] | None = None
    for matcher, names in opened:
        get = matcher.words.get
        every = []
        for data in texts:
            slices = [
                np.fromiter((get(w, -1) for w in own), dtype=np.int64, count=len(own))
                for own in words_of(data or b"")
            ]
            every.append(np.concatenate(slices) if slices else np.empty(0, np.int64))
        if found is None:
            found = [(np.zeros(len(ids), dtype=bool), set()) for ids in every]
        for ids, (hit, items) in zip(every, found):
            numbers: set[int] = set()
            matcher.match(ids, hit, numbers)
            items.update(names[i] for i in numbers if i >= 0)
    if found is None:  # no items
        sizes = [sum(map(len, words_of(data or b""))) for data in texts]
        found = [(np.zeros(n, dtype=bool), set()) for n in sizes]
    return found


def _spans(data: bytes | None, hit: np.ndarray) -> list[dict[str, int]]:
    if not hit.any():
        return []
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    starts, stops = edges[::2].tolist(), (edges[1::2] - 1).tolist()
    wanted, at = sorted({*starts, *stops}), 0
    place: dict[int, tuple[int, int]] = {}
    for number, word in enumerate(_WORD.finditer(data)):
        if number == wanted[at]:
            place[number] = word.span()
            at += 1
            if at == len(wanted):
                break
    return [{"start": place[a][0], "end": place[b][1]} for a, b in zip(starts, stops)]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    most_hit: float = 0.5,
    text: str = "text",
    **options,
) -> DataFrame:
    """The documents without the spans found; those with more than ``most_hit`` of their
    words hit are dropped. Documents without hits come back as they were."""
    own = unused("_", docs.columns)
    found = find_benchmark(
        docs, items, window, coverage, text=text, keep=tuple(docs.columns), prefix=own, **options)
    data = F.col(text).cast("binary")
    # What lies between the spans: from each span's end to the next one's start.
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col(f"{own}spans.end"))
    starts = F.concat(F.col(f"{own}spans.start"), F.array(F.octet_length(data).cast("long")))
    pieces = F.zip_with(
        ends, starts,
        lambda a, b: F.substring(data, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    cleaned = F.when(F.col(f"{own}n_hit") > 0, F.array_join(pieces, "")).otherwise(F.col(text))
    return found.where(
        F.col(f"{own}n_hit") <= F.lit(most_hit) * F.col(f"{own}n_words")
    ).withColumn(text, cleaned).select(*docs.columns)
