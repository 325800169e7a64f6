"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

Confirmed toxic texts are the positives; a sample of all texts, whatever they are, is the
unlabelled set. With class prior p and logistic loss l, a classifier f minimises

    p * mean over positives of l(f) + max(0, mean over unlabelled of l(-f)
                                             - p * mean over positives of l(-f))

where the second part estimates the risk on the negatives; where it falls below zero the
step goes back up that part alone, as the method says. Several numpy classifiers are
trained, each on its own folds of both samples, and their probabilities averaged.

Features are byte 5-grams and 6-grams of the lower-cased text with ASCII punctuation as
spaces, hashed to 2^20 slots; of these the classifiers see those that are markedly more
frequent among the positives, as presence (0 or 1) in the whole text. So the score does
not grow with the length of a text, and a word part that only toxic words have counts
also in words never seen.

Nulls: a null text is scored like an empty one; a null id is never trained on. Empty
texts get the score of a text without features. Ids that occur on several rows get a row
each and count once in training. Without any positive every score is 0. An empty table
gives no rows. Only the id and text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.llm.shared import by_size, byte_windows, mixed, plain_bytes, spread_key, unused

SLOT_BITS = 20
WIDTHS = (5, 6)
MAX_POSITIVES = 3000
MAX_UNLABELLED = 9000
MAX_FEATURES = 1024
CLASSIFIERS = 3


@dataclass(frozen=True)
class PUModel:
    slots: np.ndarray  # sorted slots of the chosen features
    weights: np.ndarray  # classifiers x features
    bias: np.ndarray  # classifiers
    prior: float

    def scores(self, present: np.ndarray) -> np.ndarray:
        """Mean probability over the classifiers; ``present`` is rows x features."""
        if not len(self.bias):
            return np.zeros(len(present))
        f = present @ self.weights.T + self.bias
        return (1 / (1 + np.exp(-np.clip(f, -30, 30)))).mean(axis=1)


def slots_of(data: bytes) -> np.ndarray:
    found = [
        mixed(byte_windows(data, width), width) >> np.uint64(64 - SLOT_BITS) for width in WIDTHS
    ]
    return np.concatenate(found).astype(np.int32)


def presence(texts: list[str | None], slots: np.ndarray) -> np.ndarray:
    """Which of the sorted ``slots`` occur in each text."""
    found = np.zeros((len(texts), len(slots)), dtype=np.float32)
    column = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
    column[slots] = np.arange(len(slots), dtype=np.int32)
    for row, text in enumerate(texts):
        at = column[slots_of(plain_bytes(text))]
        found[row, at[at >= 0]] = 1
    return found


def nn_pu_fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 200,
    rate: float = 0.1, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk with logistic loss."""
    w = np.zeros(positive.shape[1] + 1, np.float32)  # float32 as x, which is then not copied
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    p = np.hstack([positive, np.ones((len(positive), 1), positive.dtype)])
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1), unlabelled.dtype)])
    for step in range(1, steps + 1):
        fp, fu = np.clip(p @ w, -30, 30), np.clip(u @ w, -30, 30)
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        negative = np.log1p(np.exp(fu)).mean() - prior * np.log1p(np.exp(fp)).mean()
        rise = su @ u / len(u) - prior * (sp @ p) / len(p)
        if negative >= 0:
            gradient = prior * ((sp - 1) @ p) / len(p) + rise
        else:
            gradient = -rise
        gradient[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w -= (rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return w[:-1], float(w[-1])


def _chosen(df: pd.DataFrame, positives: int, unlabelled: int, most: int) -> np.ndarray:
    """Slots whose share among positives is beyond that among all, by a z score."""
    a, b = df["pos"].to_numpy() / positives, df["unl"].to_numpy() / max(unlabelled, 1)
    error = np.sqrt((b + 1 / max(unlabelled, 1)) * (1 / positives + 1 / max(unlabelled, 1)))
    z = (a - b) / error
    fit = (df["pos"].to_numpy() >= 3) & (a > 3 * b) & (z > 4)
    order = np.lexsort((df["slot"].to_numpy()[fit], -z[fit]))[:most]
    return np.sort(df["slot"].to_numpy()[fit][order])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    prior: float | None = None,
    max_positives: int = MAX_POSITIVES,
    max_unlabelled: int = MAX_UNLABELLED,
    max_features: int = MAX_FEATURES,
    classifiers: int = CLASSIFIERS,
    seed: int = 7,
) -> PUModel:
    """Train on the rows where ``learn`` (a condition on the key) holds.

    Positives are at most ``max_positives`` keys labelled 1, unlabelled texts at most
    ``max_unlabelled`` keys of all documents, those with the lowest hashes. The prior is
    the share of 1 among all labels of ``learn`` if it is not given.
    """
    known = labels.where(learn).select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    if prior is None:
        counted = known.agg(F.avg(F.col("_label").cast("double"))).first()[0]
        prior = min(max(counted or 0.0, 1e-3), 0.5)
    draw = spread_key(F.col("_key"), seed)
    lowest = lambda df, n: df.dropna().distinct().orderBy(draw, "_key").limit(n)
    positive = lowest(known.where("_label = 1").select("_key"), max_positives)
    every = lowest(docs.where(learn).select(F.col(key).alias("_key")), max_unlabelled)
    # At most max_positives + max_unlabelled keys: a bounded broadcast.
    drawn = positive.withColumn("_pos", F.lit(1)).unionByName(every.withColumn("_pos", F.lit(0)))
    drawn = drawn.groupBy("_key").agg(
        F.max("_pos").alias("_pos"), (F.min("_pos") == 0).alias("_unl")
    )
    sample = cut_lineage(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(drawn), "_key")
        .groupBy("_key", "_pos", "_unl")
        .agg(F.min("_text").alias("_text"))
    )
    empty = PUModel(np.empty(0, np.int32), np.empty((0, 0)), np.empty(0), prior)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros((2, 1 << SLOT_BITS), dtype=np.int32)
        for batch in batches:
            for value, pos, unl in zip(batch["_text"], batch["_pos"], batch["_unl"]):
                slots = np.unique(slots_of(plain_bytes(value)))
                count[0, slots] += int(pos)
                count[1, slots] += int(unl)
        at = np.flatnonzero(count[0])  # slots without a positive are never chosen
        yield pd.DataFrame({"slot": at, "pos": count[0, at], "unl": count[1, at]})

    n_pos, n_unl = sample.agg(F.sum("_pos"), F.sum(F.col("_unl").cast("int"))).first()
    if not n_pos:
        return empty
    table = (
        sample.mapInPandas(frequencies, "slot int, pos long, unl long")
        .groupBy("slot")
        .agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))
        .where("pos >= 3")
        .toPandas()  # at most 2^20 rows
    )
    slots = _chosen(table, n_pos, n_unl, max_features).astype(np.int32)

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.packbits(presence(list(batch["_text"]), slots) > 0, axis=1)
            yield pd.DataFrame(
                {"key": batch["_key"].astype(str), "pos": batch["_pos"], "unl": batch["_unl"],
                 "bits": [b.tobytes() for b in bits]}
            )

    rows = sample.mapInPandas(featured, "key string, pos int, unl boolean, bits binary").toPandas()
    rows = rows.sort_values("key", ignore_index=True)
    raw = np.frombuffer(b"".join(rows["bits"]), np.uint8).reshape(len(rows), -1)
    x = np.unpackbits(raw, axis=1, count=len(slots)).astype(np.float32)
    folds = np.arange(len(rows)) % (classifiers + 1)
    pos, unl = rows["pos"].to_numpy() == 1, rows["unl"].to_numpy()
    fitted = []
    for i in range(classifiers):
        own = folds != i
        if not (own & pos).any() or not (own & unl).any():
            own = np.ones(len(rows), dtype=bool)
        u = x[own & unl] if (own & unl).any() else x[:0].reshape(0, x.shape[1])
        u = u if len(u) else np.zeros((1, x.shape[1]), np.float32)
        fitted.append(nn_pu_fit(x[own & pos], u, prior))
    return PUModel(slots, np.array([w for w, _ in fitted]), np.array([b for _, b in fitted]), prior)


def score_toxicity(
    docs: DataFrame, model: PUModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, score and predicted (1 from 0.5 on) of every row."""
    source = docs.select(*keep, F.col(text).alias(unused("_text", keep)))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in by_size(batch):
                score = model.scores(presence(texts, model.slots))
                columns = [piece.column(i) for i in range(len(keep))]
                columns += [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

    return source.mapInArrow(rows, ", ".join([*fields, "score double", "predicted int"]))
