"""Metrics of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.columns import as_double, rounded


def regression_aggregates(label: Column, prediction: Column) -> dict[str, Column]:
    """RMSE and R2 as aggregates; R2 is NULL for a constant label."""
    error = F.pow(label - prediction, F.lit(2.0))
    paired = F.when(error.isNotNull(), label)
    return {
        "rmse": F.sqrt(F.avg(error)),
        "r2": F.lit(1.0) - F.try_divide(F.avg(error), F.var_pop(paired)),
    }


def regression_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    digits: int | None = None,
) -> DataFrame:
    """RMSE and R2 of a prediction column in one pass."""
    metrics = regression_aggregates(as_double(label), as_double(prediction))
    return df.agg(*[rounded(e, digits).alias(name) for name, e in metrics.items()])


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    digits: int | None = None,
) -> DataFrame:
    """Accuracy and F1 weighted by class frequency.

    The rows are reduced to a confusion table first; everything after it is as
    small as the number of classes squared.
    """
    confusion = df.groupBy(
        as_double(label).alias("actual"), as_double(prediction).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))
    return confusion_metrics(confusion, digits)


def confusion_metrics(confusion: DataFrame, digits: int | None = None) -> DataFrame:
    hit = F.col("actual") == F.col("predicted")
    sides = F.array(
        F.struct(
            F.col("actual").alias("class"),
            F.col("n").alias("actual_n"),
            F.lit(0).cast("long").alias("predicted_n"),
            F.when(hit, F.col("n")).otherwise(F.lit(0).cast("long")).alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("class"),
            F.lit(0).cast("long").alias("actual_n"),
            F.col("n").alias("predicted_n"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    per_class = (
        confusion.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual_n", "predicted_n", "hits")])
    )
    # 2PR / (P + R) with P = hits/predicted and R = hits/actual.
    f1 = F.coalesce(
        F.try_divide(F.col("hits") * 2.0, F.col("actual_n") + F.col("predicted_n")), F.lit(0.0)
    )
    total = F.sum("actual_n")
    return per_class.agg(
        rounded(F.try_divide(F.sum("hits") * 1.0, total), digits).alias("accuracy"),
        rounded(F.try_divide(F.sum(f1 * F.col("actual_n")), total), digits).alias("f1"),
    )
