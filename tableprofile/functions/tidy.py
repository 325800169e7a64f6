"""The tidy long form that every result can be turned into."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.functions.columns import named, text_literal

TIDY_SCHEMA = T.StructType(
    [
        T.StructField("section", T.StringType(), False),
        T.StructField("subject", T.StringType()),
        T.StructField("metric", T.StringType(), False),
        T.StructField("num_value", T.DoubleType()),
        T.StructField("str_value", T.StringType()),
    ]
)

Fact = tuple[str | None, str, float | str | None]


def tidy_cell(section: str, subject: str | None, metric: str, value: str, text: bool) -> str:
    """One tidy row as the SQL text of a struct; ``text`` says which value takes it."""
    number = "cast(null as double)" if text else f"cast({value} as double)"
    string = f"cast({value} as string)" if text else "cast(null as string)"
    return (
        f"named_struct('section', {text_literal(section)}, 'subject', {text_literal(subject)},"
        f" 'metric', {text_literal(metric)}, 'num_value', {number}, 'str_value', {string})"
    )


def tidy_facts(spark: SparkSession, section: str, facts: Iterable[Fact]) -> DataFrame:
    """Tidy rows of facts the driver already holds (a fitted model, a message)."""
    rows = [
        (section, subject, metric)
        + ((None, value) if isinstance(value, str) else (None if value is None else float(value), None))
        for subject, metric, value in facts
    ]
    return spark.createDataFrame(rows, TIDY_SCHEMA)


def melt(df: DataFrame, section: str, subject: Column, metrics: Sequence[str]) -> DataFrame:
    """Tidy form of a typed result: one output row per row and metric."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    empty_number, empty_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = []
    for metric in metrics:
        number = isinstance(kinds[metric], T.NumericType)
        value = named(metric)
        cells.append(
            F.struct(
                F.lit(metric).alias("metric"),
                (value.cast("double") if number else empty_number).alias("num_value"),
                (empty_text if number else value.cast("string")).alias("str_value"),
            )
        )
    return df.select(
        F.lit(section).alias("section"),
        subject.cast("string").alias("subject"),
        F.inline(F.array(*cells)),
    )
