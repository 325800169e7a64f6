"""What a modelling job hands back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tableprofile.functions.columns import is_missing_number, named
from tableprofile.functions.tidy import Fact, tidy_facts
from tableprofile.operators.features import (
    IS_TRAIN,
    LABEL,
    PREDICTION,
    internal_columns,
    train_flag,
)


class NoTrainingRowsError(ValueError):
    """The label is missing in every row a fit could use."""


@dataclass(frozen=True)
class FittedJob:
    """A fitted pipeline with the facts and metrics of its run."""

    job: str
    model: PipelineModel
    facts: tuple[Fact, ...]
    source: DataFrame

    def facts_frame(self) -> DataFrame:
        """The facts in tidy form."""
        return tidy_facts(self.source.sparkSession, self.job, self.facts)

    def fact(self, metric: str, subject: str | None = None) -> float | str | None:
        for found_subject, found_metric, value in self.facts:
            if (found_subject, found_metric) == (subject, metric):
                return value
        raise KeyError((subject, metric))

    def predict(self, df: DataFrame | None = None, output: str = "prediction") -> DataFrame:
        """Score raw rows (the fitted table by default) with the pipeline."""
        scored = self.model.transform(self.source if df is None else df)
        return scored.withColumnRenamed(PREDICTION, output).drop(*internal_columns(scored, [output]))


def labelled(
    df: DataFrame,
    label: Column,
    columns: Sequence[str],
    key: Sequence[str] | None,
    ratio: float,
    seed: int,
    split: str,
) -> DataFrame:
    """The label, the split side and the needed columns; nothing else is read."""
    side = train_flag(columns, key, ratio, seed, split)
    kept = list(dict.fromkeys(columns))
    return df.select(
        *[named(c) for c in kept], label.cast("double").alias(LABEL), side.alias(IS_TRAIN)
    )


def has_label() -> Column:
    return ~is_missing_number(F.col(LABEL))


def training_rows(prepared: DataFrame) -> DataFrame:
    train = prepared.filter(has_label() & F.col(IS_TRAIN))
    if train.isEmpty():
        raise NoTrainingRowsError("No training row has a label")
    return train


def side_counts() -> list[Column]:
    """Training, test and dropped rows as aggregates over prepared rows."""
    return [
        F.count_if(has_label() & F.col(IS_TRAIN)).alias("training_rows"),
        F.count_if(has_label() & ~F.col(IS_TRAIN)).alias("test_rows"),
        F.count_if(~has_label()).alias("dropped_rows"),
    ]


def count_facts(row: Row) -> list[Fact]:
    return [(None, c, row[c]) for c in ("training_rows", "test_rows", "dropped_rows")]


def rounded_value(value: float | None, digits: int | None) -> float | None:
    if value is None:
        return None
    return float(value) if digits is None else round(float(value), digits)
