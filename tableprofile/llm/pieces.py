"""SentencePiece encoding by suffix-array matching, and decoding.

The parts of a batch between spaces are collected once each and concatenated; a suffix
array over that text is built by doubling up to the longest piece. Binary search finds the
range of suffixes that start with each piece of the vocabulary; every suffix of a range is
an edge (position, length, piece). The edges are sorted by position and length, and then
relaxed to a segmentation of every part.

The vocabulary is of the BPE kind, so relaxing follows its rule: among the edges that
span two neighbouring symbols the one with the highest score, the leftmost of equals, is
taken until none is left. Parts of up to ``SHORT`` characters are relaxed together,
a step each per round; longer ones by a queue over the same edges. Characters without an
edge become byte ids. No piece joins a character to a following space, so texts may be cut
before every run of spaces; ids of parts are kept for later texts of the task.

Null text counts as empty and has no ids. Texts of any length go through whole. Repeated
rows get a row each; ids may be null. An empty table gives no rows. Only the named columns
are read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.shared import by_size, kept_in_worker, unused

SPACE = "▁"
SHORT = 64
CACHED_PARTS = 500_000
BATCH_BYTES = 4 << 20
NUL = "\udc00"  # stands for U+0000 between parts; no text of Spark holds half a surrogate


class Pieces:
    """Vocabulary of a model file: pieces, their order of merging, bytes for decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        scores = np.array([model.get_score(i) for i in plain])
        kinds, order = np.unique(-scores, return_inverse=True)
        self.ids = np.array(plain, dtype=np.int64)
        self.turn = order.astype(np.int64)  # 0 is merged first; equal scores share a turn
        self.turns = len(kinds)
        self.lengths = np.array([len(texts[i]) for i in plain], dtype=np.int64)
        self.longest = int(self.lengths.max())
        self.turn_of_id = np.full(size, self.turns, dtype=np.int64)
        self.turn_of_id[self.ids] = self.turn
        self.codes = np.zeros((len(plain), self.longest + 1), dtype=np.uint32)
        for row, i in enumerate(plain):
            self.codes[row, : len(texts[i])] = [ord(c) for c in texts[i]]
        self.byte_ids = np.zeros(256, dtype=np.int64)
        output: list[bytes] = []
        for i in range(size):
            if model.is_byte(i):
                value = int(texts[i][3:-1], 16)
                self.byte_ids[value] = i
                output.append(bytes([value]))
            elif model.is_control(i):
                output.append(b"")
            elif model.is_unknown(i):
                output.append(" ⁇ ".encode())
            else:
                output.append(texts[i].replace(SPACE, " ").encode("utf-8"))
        self.output_bytes = np.frombuffer(b"".join(output), np.uint8)
        self.output_size = np.array([len(x) for x in output], dtype=np.int64)
        self.output_start = np.cumsum(self.output_size) - self.output_size
        # No merge crosses two characters that no piece holds side by side.
        beside = {t[k : k + 2] for t in map(texts.__getitem__, plain) for k in range(len(t) - 1)}
        letters = [chr(c) for c in range(128) if chr(c).isalpha()]
        marks = [m for m in ".,;:!?" if not any(x + m in beside for x in letters)]
        cuts = [rf"(?<=[a-zA-Z])(?=[{re.escape(''.join(marks))}])"] if marks else []
        if not any("\n" in pair for pair in beside):
            cuts += [r"(?<=\n)", r"(?=\n)"]
        self.cut = re.compile("|".join(cuts)) if cuts else None

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, without the space that encoding puts in front."""
        ids = np.asarray(ids, dtype=np.int64)
        size = self.output_size[ids]
        shift = self.output_start[ids] - (np.cumsum(size) - size)
        data = self.output_bytes[np.repeat(shift, size) + np.arange(size.sum())].tobytes()
        return data.removeprefix(b" ").decode("utf-8", "replace")


def edges_of(codes: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of pieces: sorted keys position * 32 + length, and piece ids.

    ``codes`` are code points with 0 between the parts.
    """
    width = pieces.longest + 1  # so that a piece is always shorter than a window
    seen = np.bincount(codes, minlength=1) > 0
    alphabet = np.flatnonzero(seen)  # holds 0, which is smaller than any character
    ranks = (np.cumsum(seen) - 1)[codes]
    # Big-endian, so that byte strings order like the codes.
    padded = np.concatenate([ranks, np.zeros(width, ranks.dtype)]).astype(">u4")
    done = 1
    while done < width:
        later = np.zeros_like(ranks)
        later[:-done] = ranks[done:]
        keys = ranks * (int(later.max()) + 1) + later
        array = np.argsort(keys)
        keys = keys[array]
        ranks[array] = np.cumsum(np.r_[0, keys[1:] != keys[:-1]])
        done *= 2
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)[array]
    keys = np.ascontiguousarray(windows).view(f"V{4 * width}").ravel()
    rows = np.searchsorted(alphabet, pieces.codes)
    rows[rows == len(alphabet)] = 0
    inside = np.arange(width) < pieces.lengths[:, None]
    usable = ((alphabet[rows] == pieces.codes) | ~inside).all(axis=1)
    low = np.where(inside, rows, 0)[usable].astype(">u4")
    high = np.where(inside, rows, 0xFFFFFFFF)[usable].astype(">u4")
    first = _search(keys, low)
    last = _search(keys, high)
    count = last - first
    which = np.repeat(np.flatnonzero(usable), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = array[np.repeat(first, count) + place]
    spans = at * 32 + pieces.lengths[which]
    order = np.argsort(spans)  # no two are equal
    return spans[order], pieces.ids[which][order]


def _search(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Left insertion points by binary search over byte strings in memory order."""
    width = keys.dtype.itemsize
    as_bytes = keys.view(f"S{width}")
    return np.searchsorted(as_bytes, np.ascontiguousarray(wanted).view(f"S{width}").ravel())


class Relaxer:
    """Segmentations of parts of one indexed text."""

    def __init__(self, codes: np.ndarray, pieces: Pieces):
        self.pieces, self.codes = pieces, codes
        self.spans, self.ids = edges_of(codes, pieces)

    def id_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Piece that spans [start, end), -1 where there is none."""
        length = end - start
        wanted = start * 32 + np.minimum(length, 31)
        at = np.minimum(np.searchsorted(self.spans, wanted), max(len(self.spans) - 1, 0))
        if not len(self.spans):
            return np.full(len(start), -1, dtype=np.int64)
        hit = (self.spans[at] == wanted) & (length <= self.pieces.longest)
        return np.where(hit, self.ids[at], -1)

    def turns(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        ids = self.id_of(start, end)
        return np.where(ids < 0, self.pieces.turns, self.pieces.turn_of_id[ids])

    def together(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (start, end) of all the parts, in order, relaxed a step each per round."""
        part = np.repeat(np.arange(len(starts)), ends - starts)
        place = np.arange(len(part)) - np.repeat(np.cumsum(ends - starts) - (ends - starts),
                                                 ends - starts)
        left = starts[part] + place
        right = left + 1
        final_left, final_right = [], []
        none = self.pieces.turns
        turn = self._pairs(left, right, part)
        while len(left):
            # Best pair of every part: turn first, then position.
            heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            key = turn * (1 << 32) + np.arange(len(left))
            best = np.minimum.reduceat(key, heads)
            over = best >= none * (1 << 32)
            if over.any():
                done = np.repeat(over, np.diff(np.r_[heads, len(left)]))
                final_left.append(left[done])
                final_right.append(right[done])
                left, right, part, turn = left[~done], right[~done], part[~done], turn[~done]
                continue
            at = best & ((1 << 32) - 1)
            right[at] = right[at + 1]
            stays = np.ones(len(left), dtype=bool)
            stays[at + 1] = False
            moved = np.cumsum(stays) - 1
            left, right, part, turn = left[stays], right[stays], part[stays], turn[stays]
            at = moved[at]
            touched = np.zeros(len(left), dtype=bool)
            touched[at] = touched[np.maximum(at - 1, 0)] = True
            again = np.flatnonzero(touched)
            turn[again] = self._pairs_at(left, right, part, again)
        left = np.concatenate(final_left) if final_left else np.empty(0, np.int64)
        right = np.concatenate(final_right) if final_right else np.empty(0, np.int64)
        order = np.argsort(left)
        return left[order], right[order]

    def _pairs(self, left, right, part):
        return self._pairs_at(left, right, part, np.arange(len(left)))

    def _pairs_at(self, left, right, part, at):
        following = np.minimum(at + 1, len(left) - 1)
        turn = self.turns(left[at], right[following])
        alone = (at + 1 >= len(left)) | (part[following] != part[at])
        return np.where(alone, self.pieces.turns, turn)

    def by_queue(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of one long part, in O(n log n)."""
        n = end - start
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        stop = list(range(start + 1, end + 1))
        lefts = np.arange(start, end - 1)
        turn = self.turns(lefts, lefts + 2).tolist()
        none = self.pieces.turns
        queue = [(t, i, i + 2) for i, t in enumerate(turn) if t < none]
        heapq.heapify(queue)
        gone = [False] * n

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                a, b = np.array([start + i]), np.array([stop[j]])
                t = int(self.turns(a, b)[0])
                if t < none:
                    heapq.heappush(queue, (t, i, stop[j] - start))

        while queue:
            _, i, reach = heapq.heappop(queue)
            j = after[i] if not gone[i] else n
            if j >= n or stop[j] - start != reach:
                continue
            stop[i], after[i], gone[j] = stop[j], after[j], True
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        kept = np.array([i for i in range(n) if not gone[i]], dtype=np.int64)
        return kept + start, np.array(stop, dtype=np.int64)[kept]


class Encoder:
    """Ids of texts; parts that were seen before in the task are looked up."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.known: dict[str, bytes] = {}
        self.indexed: dict[str, bytes] = {}  # what known parts consist of
        self.run = re.compile(f"{SPACE}+[^{SPACE}]*")

    def parts(self, text: str) -> list[str]:
        """The text before each run of spaces, without the first space of the run."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        if SPACE * 2 not in marked and marked[-1] != SPACE:
            return marked.split(SPACE)[1:]
        return [found[1:] for found in self.run.findall(marked)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self.parts(text or "") for text in texts]
        new = set().union(*cut).difference(self.known)
        if new:
            self._learn(list(new))
        found = [b"".join(map(self.known.__getitem__, parts)) for parts in cut]
        if len(self.known) > CACHED_PARTS:
            self.known, self.indexed = {}, {}
        return found

    def _learn(self, new: list[str]) -> None:
        cut = self.pieces.cut
        # A part of letters only is never cut.
        whole = [p for p in new if cut is None or p.isalpha()]
        mixed = [p for p in new if not (cut is None or p.isalpha())]
        made = [[x for x in cut.split(SPACE + part) if x] for part in mixed]
        unseen = set().union(*made, [SPACE + part for part in whole]).difference(self.indexed)
        if unseen:
            self._index(list(unseen))
        ids = self.indexed
        for part in whole:
            self.known[part] = ids[SPACE + part]
        for part, own in zip(mixed, made):
            self.known[part] = b"".join([ids[x] for x in own])

    def _index(self, new: list[str]) -> None:
        joined = "\0".join(part.replace("\0", NUL) for part in new) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.flatnonzero(codes == 0)
        starts = np.r_[0, ends[:-1] + 1]
        relaxer = Relaxer(codes, self.pieces)
        short = ends - starts <= SHORT
        left, right = relaxer.together(starts[short], ends[short])
        for a, b in zip(starts[~short].tolist(), ends[~short].tolist()):
            more = relaxer.by_queue(a, b)
            left, right = np.r_[left, more[0]], np.r_[right, more[1]]
        order = np.argsort(left)
        left, right = left[order], right[order]
        ids = relaxer.id_of(left, right)
        ids, left = self._with_bytes(ids, left, codes)
        flat = ids.astype("<u4").tobytes()
        first = np.searchsorted(left, starts).tolist()
        last = np.searchsorted(left, ends).tolist()
        for part, a, b in zip(new, first, last):
            self.indexed[part] = flat[4 * a : 4 * b]

    def _with_bytes(self, ids, left, codes):
        """Characters without a piece as the ids of their UTF-8 bytes."""
        lost = np.flatnonzero(ids < 0)
        if not len(lost):
            return ids, left
        spelled = [
            (b"\0" if c == ord(NUL) else chr(c).encode("utf-8", "replace"))
            for c in codes[left[lost]].tolist()
        ]
        count = np.ones(len(ids), dtype=np.int64)
        count[lost] = [len(s) for s in spelled]
        wide, at = np.repeat(ids, count), np.repeat(left, count)
        wide[np.repeat(ids < 0, count)] = self.pieces.byte_ids[
            np.frombuffer(b"".join(spelled), np.uint8)
        ]
        return wide, at


def encode_pieces(
    docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns and the ``ids`` (array of int) of every text."""
    return _mapped(docs, model_path, text, keep, "ids array<int>", _as_arrays)


def encoding_digest(
    docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns, n_ids, ids_crc32, and whether decoding gives the text again."""
    fields = "n_ids long, ids_crc32 long, round_trip boolean"
    return _mapped(docs, model_path, text, keep, fields, _as_digest)


def decode_pieces(
    df: DataFrame, model_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns and the ``text`` of each array of ids; a null array is null text."""
    source = df.select(*keep, F.col(ids).cast("array<int>").alias(unused("_ids", keep)))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = kept_in_worker(f"pieces {model_path}", lambda: Pieces(model_path))
        for batch in batches:
            lists = batch.column(batch.num_columns - 1).to_pylist()
            texts = [None if x is None else pieces.decode(np.array(x, np.int64)) for x in lists]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string())], names=[*keep, "text"])

    return source.mapInArrow(rows, ", ".join([*fields, "text string"]))


def _as_arrays(encoder: Encoder, texts: list, found: list[bytes]) -> list[pa.Array]:
    ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in found]
    return [pa.array(ids, pa.list_(pa.int32()))]


def _as_digest(encoder: Encoder, texts: list, found: list[bytes]) -> list[pa.Array]:
    same = [
        encoder.pieces.decode(np.frombuffer(x, "<u4")) == (text or "").replace(SPACE, " ")
        for text, x in zip(texts, found)
    ]
    return [
        pa.array([len(x) // 4 for x in found], pa.int64()),
        pa.array([zlib.crc32(x) for x in found], pa.int64()),
        pa.array(same, pa.bool_()),
    ]


def _mapped(docs, model_path, text, keep, fields, columns_of) -> DataFrame:
    source = docs.select(*keep, F.col(text).alias(unused("_text", keep)))
    given = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    names = [part.split()[0] for part in fields.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(f"encoder {model_path}", lambda: Encoder(model_path))
        for batch in batches:
            for piece, texts in by_size(batch, BATCH_BYTES):
                found = encoder.encode(texts)
                kept = [piece.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *columns_of(encoder, texts, found)], names=[*keep, *names])

    return source.mapInArrow(rows, ", ".join([*given, fields]))
