"""Quality rules: base counts of a text, and bands of zstandard ratios.

A ratio is plain bytes over compressed bytes. Repetitive text compresses too well,
encoded or random text hardly at all. Short texts compress less, so every band has its
own limits by length in bytes. Two measures are taken of every text: of the whole, and of
each fixed chunk of it, so that a long good text does not hide a bad passage for good: a
text fails if the whole is outside its band or if more than ``chunk_share`` of the bytes
lie in chunks outside theirs.

Null text counts as empty. Empty texts fail the base rule (fewer than 50 words) and are
compared with no band. Repeated rows each get a row; nothing is joined, so names of extra
columns never clash. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.shared import by_size, unused

_SYMBOLS = re.compile(rb"[#*$%&|<>]")


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for texts of fewer than ``below`` bytes (None: any length)."""

    below: int | None
    least: float
    most: float


# At this level prose compresses about 1.2 to 1.6 times at 256 bytes, 2 times at 4 kB and
# 2.3 to 2.8 times beyond 16 kB; base64 or hexadecimal digits stay under 1.35 and 2;
# looped text soon goes beyond 4. The limits leave room on both sides of prose.
WHOLE_BANDS = (
    Band(256, 0.70, 2.0),
    Band(512, 1.00, 2.3),
    Band(1024, 1.15, 2.5),
    Band(4096, 1.30, 2.8),
    Band(16384, 1.50, 3.2),
    Band(None, 1.60, 3.8),
)
CHUNK_BYTES = 4096
CHUNK_SHARE = 0.5
LEVEL = 3


def band_of(bands: tuple[Band, ...], size: int) -> Band:
    return next(b for b in bands if b.below is None or size < b.below)


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated 3-word windows.

    ``bytes.split`` cuts at space and \\x09-\\x0D exactly, and UTF-8 never uses those bytes
    inside a character.
    """
    words = data.split()
    joined = b"".join(words)
    letters = len(joined) - _continuation(joined)
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return (
        len(words),
        letters,
        len(_SYMBOLS.findall(data)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
    )


def _continuation(data: bytes) -> int:
    raw = np.frombuffer(data, dtype=np.uint8)
    return int(np.count_nonzero((raw & 0xC0) == 0x80))


def _repeated_words(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    kinds = len(index)
    # A pair of word numbers first, then pair and word: both fit an integer of 64 bits.
    pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1]
    triples = pairs[:-1] * kinds + ids[2:]
    _, where, count = np.unique(triples, return_inverse=True, return_counts=True)
    again = count[where] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(np.count_nonzero(covered))


class Ratios:
    """Compression ratios of whole texts and of their chunks against the bands."""

    def __init__(self, bands=WHOLE_BANDS, chunk_bytes=CHUNK_BYTES, level=LEVEL):
        self.bands, self.chunk_bytes = bands, chunk_bytes
        self.compressor = zstandard.ZstdCompressor(
            level=level, write_content_size=False, write_checksum=False
        )

    def ratio(self, data: bytes) -> float:
        return len(data) / len(self.compressor.compress(data))

    def outside(self, data: bytes) -> tuple[float, bool]:
        value, band = self.ratio(data), band_of(self.bands, len(data))
        return value, not band.least <= value <= band.most

    def measure(self, data: bytes) -> tuple[float | None, bool, float]:
        """Ratio of the whole, whether it is outside, share of bytes in chunks outside."""
        if not data:
            return None, False, 0.0
        whole, bad = self.outside(data)
        if len(data) <= self.chunk_bytes:
            return whole, bad, float(bad)
        cut = [data[i : i + self.chunk_bytes] for i in range(0, len(data), self.chunk_bytes)]
        wrong = sum(len(c) for c in cut if self.outside(c)[1])
        return whole, bad, wrong / len(data)


def compression_bands(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    bands: tuple[Band, ...] = WHOLE_BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_share: float = CHUNK_SHARE,
    min_words: int = 50,
    max_repeated_percent: int = 50,
    prefix: str = "",
) -> DataFrame:
    """Base counts, ratios and the verdict ``kept`` of every row; ``keep`` columns lead;
    the names of the others begin with ``prefix``.

    ``base_failed``: under ``min_words`` words, or over ``max_repeated_percent`` percent of
    them in repeated 3-word windows. ``kept`` is false for those, else the bands decide.
    """
    carried = list(keep)
    measured = ", ".join(prefix + part for part in (
        "n_words long", "word_chars long", "n_symbols long", "n_dup_lines long",
        "n_repeat_words long", "base_failed boolean", "kept boolean", "ratio double",
        "bad_chunk_share double",
    ))
    source = docs.select(*carried, F.col(text).alias(unused("_text", carried)))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    names = [part.split()[0] for part in measured.split(",")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = Ratios(bands, chunk_bytes)
        for batch in batches:
            for piece, texts in by_size(batch):
                found = [verdict(t, ratios) for t in texts]
                columns = [piece.column(i) for i in range(len(carried))]
                columns += [
                    pa.array(c, type=kind)
                    for c, kind in zip(zip(*found), _KINDS)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, *names])

    def verdict(value: str | None, ratios: Ratios) -> tuple:
        data = (value or "").encode("utf-8", "replace")
        counts = base_counts(data)
        n, repeated = counts[0], counts[4]
        failed = n < min_words or 100 * repeated > max_repeated_percent * n
        whole, bad, share = ratios.measure(data)
        return *counts, failed, not failed and not bad and share <= chunk_share, whole, share

    return source.mapInArrow(rows, ", ".join([*fields, measured]))


_KINDS = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
