"""Language identification in two levels: the family first, then one language against one.

Families are decided by linear support vector machines (one against the rest), languages
within the family by one machine for each pair, with the most votes winning and the pair
probabilities deciding ties. All machines are linear in the shares of hashed byte
3-grams of the lower-cased text, so the margin of a whole text of any length is the mean
of a table over its positions, and a text is read once for all machines.

Learning takes a bounded sample of labelled rows for each language. ``FAMILIES`` names
the family of common languages; any other language is a family of its own.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows whose language
or id is null are not learned from but predicted. Repeated rows get a row each and count
once in learning. If no language was learned every row is ``und``; if one was, every
text with a letter gets it. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.shared import (
    by_size,
    byte_windows,
    letter_pattern,
    mixed,
    plain_bytes,
    spread_key,
    unused,
)

# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "cy", "gd", "br"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne", "si"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("ar", "he", "am", "mt"),
}
UNKNOWN = "und"
SLOT_BITS = 12
WIDTH = 3
MAX_PER_LANGUAGE = 1000


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), f"only {lang}")


@dataclass(frozen=True)
class Machines:
    """Linear machines over 3-gram shares: a column of ``table`` and a bias each."""

    table: np.ndarray  # slots x machines
    bias: np.ndarray
    slope: np.ndarray  # of the logistic curve over a margin
    families: tuple[str, ...]
    family_column: dict[str, int]
    pair_column: dict[tuple[str, str], int]
    languages: dict[str, tuple[str, ...]]  # family -> languages

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        """Language and score from the margins of one text."""
        sure = 1 / (1 + np.exp(-np.clip(margins * self.slope, -30, 30)))
        if not self.families:
            return UNKNOWN, 0.0
        chance = [sure[self.family_column[f]] if f in self.family_column else 1.0
                  for f in self.families]
        at = int(np.argmax(chance))
        family, share = self.families[at], chance[at] / max(sum(chance), 1e-12)
        langs = self.languages[family]
        votes, weight = dict.fromkeys(langs, 0), dict.fromkeys(langs, 1.0)
        for a, b in combinations(langs, 2):
            p = float(sure[self.pair_column[a, b]])
            votes[a if p >= 0.5 else b] += 1
            weight[a], weight[b] = weight[a] * p, weight[b] * (1 - p)
        best = max(langs, key=lambda x: (votes[x], weight[x]))
        return best, float(min(1.0, share * weight[best] / max(sum(weight.values()), 1e-12)))


def slots_of(data: bytes) -> np.ndarray:
    hashed = mixed(byte_windows(data, WIDTH), WIDTH) >> np.uint64(64 - SLOT_BITS)
    return hashed.astype(np.int32)


def linear_svm(x: np.ndarray, y: np.ndarray, steps: int = 150, strength: float = 1e-4):
    """Weights and bias of a soft-margin machine by subgradient steps on the hinge loss.

    Both classes weigh the same. ``y`` holds 1 and -1.
    """
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w, b = np.zeros(x.shape[1], np.float32), 0.0  # float32 as x, which is then not copied
    mean_w, mean_b = np.zeros_like(w), 0.0
    for step in range(1, steps + 1):
        active = y * (x @ w + b) < 1
        push = np.where(active, weight * y, 0.0).astype(np.float32)
        rate = np.float32(20.0 / np.sqrt(step))
        w += rate * (push @ x - np.float32(strength) * w)
        b += rate * 0.1 * push.sum()
        mean_w += (w - mean_w) / np.float32(step)
        mean_b += (b - mean_b) / step
    return mean_w, float(mean_b)


def _slope(margins: np.ndarray, y: np.ndarray) -> float:
    """Slope of a logistic curve through the margins: the best of a small grid."""
    grid = np.array([0.5, 1, 2, 3, 4, 6, 8])
    loss = [np.log1p(np.exp(-np.clip(y * margins * s, -30, 30))).mean() for s in grid]
    return float(grid[int(np.argmin(loss))])


# Shares are small; this brings their norm near one.
_SCALE = 10.0


def fit_languages(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_per_language: int = MAX_PER_LANGUAGE,
    seed: int = 5,
) -> Machines:
    """Train on about ``max_per_language`` rows of each language where ``learn`` holds.

    The sample is drawn by hash of the key at a rate for each language, so no task gathers
    the rows of one. What comes to the driver is one row of counts for each drawn text.
    """
    usable = docs.where(learn).where(
        F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull()
    ).select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    sizes = {r["_lang"]: r["count"] for r in usable.groupBy("_lang").count().collect()}
    if not sizes:
        return Machines(np.zeros((1 << SLOT_BITS, 0), np.float32), np.zeros(0), np.zeros(0),
                        (), {}, {}, {})
    rate = F.create_map(*[
        F.lit(v) for name, n in sizes.items() for v in (name, min(1.0, max_per_language / n))
    ])
    drawn = usable.where(spread_key(F.col("_key"), seed) < rate[F.col("_lang")])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shares = []
            for value in batch["_text"]:
                slots = slots_of(plain_bytes(value))
                count = np.bincount(slots, minlength=1 << SLOT_BITS)
                shares.append((count / max(len(slots), 1)).astype(np.float16).tobytes())
            yield pd.DataFrame(
                {"key": batch["_key"].astype(str), "lang": batch["_lang"], "shares": shares}
            )

    # 8 kB a row; rows with the same key and language count once.
    rows = (
        drawn.mapInPandas(counted, "key string, lang string, shares binary")
        .groupBy("key", "lang").agg(F.min("shares").alias("shares"))
        .toPandas().sort_values(["key", "lang"], ignore_index=True)
    )
    x = np.frombuffer(b"".join(rows["shares"]), np.float16).reshape(len(rows), -1)
    x = x.astype(np.float32)
    x *= _SCALE
    langs = rows["lang"].to_numpy()
    return _train(x, langs)


def _train(x: np.ndarray, langs: np.ndarray) -> Machines:
    families: dict[str, tuple[str, ...]] = {}
    for name in sorted(set(langs)):
        families[family_of(name)] = (*families.get(family_of(name), ()), name)
    of_row = np.array([family_of(name) for name in langs])
    columns, family_column, pair_column = [], {}, {}

    def add(rows: np.ndarray, y: np.ndarray) -> int:
        w, b = linear_svm(x[rows], y)
        columns.append((w, b, _slope(x[rows] @ w + b, y)))
        return len(columns) - 1

    everyone = np.arange(len(langs))
    if len(families) > 1:
        for name in families:
            family_column[name] = add(everyone, np.where(of_row == name, 1.0, -1.0))
    for members in families.values():
        for a, b in combinations(members, 2):
            rows = np.flatnonzero((langs == a) | (langs == b))
            pair_column[a, b] = add(rows, np.where(langs[rows] == a, 1.0, -1.0))
    table = np.zeros((1 << SLOT_BITS, len(columns)), np.float32)
    for column, (w, _, _) in enumerate(columns):
        table[:, column] = w * _SCALE
    return Machines(
        table, np.array([b for _, b, _ in columns]),
        np.array([s for _, _, s in columns]), tuple(families), family_column, pair_column,
        families,
    )


def predict_language(
    docs: DataFrame, machines: Machines, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    prefix: str = "",
) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row; ``prefix`` leads the last two."""
    source = docs.select(*keep, F.col(text).alias(unused("_text", keep)))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letter_pattern()

        def one(value: str | None) -> tuple[str, float]:
            if not value or not letter.search(value):
                return UNKNOWN, 0.0
            at = slots_of(plain_bytes(value))
            sums = np.zeros(machines.table.shape[1])
            if len(sums):
                count = np.bincount(at, minlength=1 << SLOT_BITS).astype(np.float32)
                sums = count @ machines.table
            return machines.decide(sums / max(len(at), 1) + machines.bias)

        for batch in batches:
            for piece, texts in by_size(batch):
                found = [one(t) for t in texts]
                columns = [piece.column(i) for i in range(len(keep))]
                columns += [pa.array([f[0] for f in found], pa.string()),
                            pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, f"{prefix}lang_pred", f"{prefix}score"])

    return source.mapInArrow(rows, ", ".join(
        [*fields, f"{prefix}lang_pred string", f"{prefix}score double"]))
