"""Feature preparation: filling, assembling, labels, splits and baskets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile import defaults
from tableprofile.functions.columns import named, numeric_columns, quoted, require_columns
from tableprofile.functions.hashing import content_bucket, md5_bucket

# Columns the jobs add carry this prefix, so a table may hold its own "label"
# or "features".
PREFIX = "__tp_"
FEATURES = PREFIX + "features"
LABEL = PREFIX + "label"
PREDICTION = PREFIX + "prediction"
PROBABILITY = PREFIX + "probability"
RAW_PREDICTION = PREFIX + "raw_prediction"
IS_TRAIN = PREFIX + "is_train"

_BUCKETS = 1000


def choose_features(
    df: DataFrame,
    label: str | None = None,
    features: Sequence[str] | None = None,
    max_features: int | None = defaults.FEATURE_COLUMNS,
) -> list[str]:
    """The named features, or the first numeric columns other than the label."""
    if features:
        return require_columns(df, features)
    chosen = [name for name in numeric_columns(df) if name != label][:max_features]
    if not chosen:
        raise ValueError(defaults.NO_FEATURE_COLUMNS)
    return chosen


def fill_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and NaN replaced by 0 in the given numeric columns."""
    return df.na.fill(0, subset=require_columns(df, columns))


def feature_stages(features: Sequence[str]) -> list:
    """Pipeline stages from raw columns to a feature vector.

    The filling is a stage too, so a fitted pipeline scores raw rows.
    """
    filled = [f"{PREFIX}f{i}" for i in range(len(features))]
    doubles = ", ".join(
        f"nanvl(coalesce(cast({quoted(column)} as double), 0D), 0D) as {name}"
        for column, name in zip(features, filled)
    )
    return [
        SQLTransformer(statement=f"select *, {doubles} from __THIS__"),
        VectorAssembler(inputCols=filled, outputCol=FEATURES),
    ]


def internal_columns(df: DataFrame, keep: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c.startswith(PREFIX) and c not in keep]


def binarise(df: DataFrame, column: str, threshold: float, output: str = "label") -> DataFrame:
    """1.0 where the value is above the threshold, else 0.0; NULL and NaN rows go."""
    value = named(column).cast("double")
    return df.filter(value.isNotNull() & ~F.isnan(value)).withColumn(
        output, F.when(value > F.lit(threshold), 1.0).otherwise(0.0)
    )


def train_flag(
    columns: Sequence[str],
    key: Sequence[str] | None,
    ratio: float,
    seed: int,
    method: str = "hash",
) -> Column:
    """True for training rows.

    ``method="hash"`` decides by the key (md5, portable to other engines) or,
    without one, by the row's own values; either way the side does not depend
    on partitioning. ``method="random"`` draws per row and does.
    """
    if method == "random":
        return F.rand(seed) < F.lit(ratio)
    if method != "hash":
        raise ValueError(f"Unknown split method: {method}")
    bucket = (
        md5_bucket(key, seed, _BUCKETS) if key else content_bucket(columns, seed, _BUCKETS)
    )
    return bucket < F.lit(round(ratio * _BUCKETS))


def split_by_key(
    df: DataFrame,
    key: Sequence[str] | None = None,
    train_ratio: float = defaults.TRAIN_RATIO,
    seed: int = defaults.SEED,
    method: str = "hash",
    output: str = "is_train",
) -> DataFrame:
    """Mark each row as training or test by a seeded hash; no shuffle, no sort."""
    if key:
        require_columns(df, key)
    return df.withColumn(output, train_flag(df.columns, key, train_ratio, seed, method))


def item(column: str) -> Column:
    """``column_value``, or NULL where the value is NULL."""
    return F.concat(F.lit(column + "_"), named(column).cast("string"))


def basket_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_cols: int | None = defaults.BASKET_COLUMNS,
) -> list[str]:
    return require_columns(df, columns) if columns else df.columns[:max_cols]


def baskets(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_cols: int | None = defaults.BASKET_COLUMNS,
) -> DataFrame:
    """Each row as the set of its ``column_value`` items; rows without any go."""
    chosen = basket_columns(df, columns, max_cols)
    items = F.array_distinct(F.array_compact(F.array(*[item(c) for c in chosen])))
    return df.select(items.alias("items")).filter(F.size("items") > 0)


@contextmanager
def working_set(df: DataFrame, partitions: int | None = None) -> Iterator[DataFrame]:
    """Rows a fit reads several times, kept in memory and beyond it on disk meanwhile.

    ``df`` should hold the needed columns only. Rows that lie in fewer partitions than the
    session has cores (or than ``partitions``) are spread once, so that every pass uses all
    cores; a large scan has more partitions than that and stays as it is.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    kept = [df.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        held = kept[0].select(F.spark_partition_id().alias("at")).distinct().count()
        if 0 < held < wanted:
            kept.append(kept[0].repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK))
        yield kept[-1]
    finally:
        for own in kept:
            own.unpersist()
