"""The most frequent values of many columns at once, without shuffling what is distinct."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile import defaults
from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.functions.columns import named, require_columns

_SCHEMA = "column string, rank int, value string, count bigint"
# A column's rows are counted by this many parts of its values.
BUCKETS = 16_384
# Counted parts of a group of columns, which Spark sends to every task: 2 ** 19 rows of 16 bytes.
_COUNTED = 2**19
# The heaviest parts whose values are counted first, for each wanted value.
_LEADING = 4


def _groupable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _groupable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_groupable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def top_values(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    top_n: int = defaults.TOP_VALUES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The ``top_n`` most frequent values of each column as text, with exact counts.

    Equal counts are ranked in the order of the column's own type, NULL first and counted as a
    value. Columns that hold maps or variants, which have no order, are left out unless named,
    and are an error if named.

    A first scan counts the rows of each column by parts of its values, the mergeable counters
    of a sketch: no value is in more rows than its part. The values in the heaviest parts are
    counted exactly; the count of the last wanted one is a bound that certifies every lighter
    part as free of wanted values. The last scan counts the values of the parts that are left.
    So few values reach a shuffle where some are frequent. Where none is, as in a key, all
    parts stay, and the values are counted as ``value_counts`` does.
    """
    if top_n < 1 or buckets < 1:
        raise ValueError("top_n and buckets must be at least 1")
    if columns is None:
        chosen = [f.name for f in df.schema.fields if _groupable(f.dataType)]
    else:
        chosen = require_columns(df, columns)
        odd = [c for c in chosen if not _groupable(df.schema[c].dataType)]
        if odd:
            raise ValueError(f"Columns without an order: {', '.join(odd)}")
    width = max(1, _COUNTED // buckets)
    groups = [chosen[at : at + width] for at in range(0, len(chosen), width)]
    found = [_top_of_group(df, group, top_n, buckets) for group in groups]
    if not found:
        return df.sparkSession.createDataFrame([], _SCHEMA)
    return reduce(DataFrame.unionByName, found)


def _bucket(name: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(named(name)), F.lit(buckets)).cast("int")


def _top_of_group(df: DataFrame, names: Sequence[str], top_n: int, buckets: int) -> DataFrame:
    parts = F.array(*[
        F.struct(F.lit(k).alias("position"), _bucket(c, buckets).alias("bucket"))
        for k, c in enumerate(names)])
    counted = df.select(F.inline(parts)).groupBy("position", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(counted)

    heaviest = Window.partitionBy("position").orderBy(F.desc("n"), "bucket")
    leading = counted.withColumn("place", F.row_number().over(heaviest)).where(
        F.col("place") <= _LEADING * top_n)
    first = reduce(DataFrame.unionByName, [
        rows.select("position", "n") for rows in _counted_values(df, names, buckets, leading)])
    last = Window.partitionBy("position").orderBy(F.desc("n"))
    bounds = first.withColumn("place", F.row_number().over(last)).where(F.col("place") == top_n)
    bound = {row["position"]: row["n"] for row in bounds.collect()}

    # Fewer values than wanted in that many parts: there are no others.
    least = F.get(F.array(*[F.lit(bound.get(k, 0)).cast("long") for k in range(len(names))]), F.col("position"))
    left = counted.where(F.col("n") >= least)
    ranks = Window.partitionBy("position").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    title = F.get(F.array(*[F.lit(c) for c in names]), F.col("position"))
    return reduce(DataFrame.unionByName, [
        rows.withColumn("place", F.row_number().over(ranks)).where(F.col("place") <= top_n).select(
            title.alias("column"), F.col("place").alias("rank"),
            F.col("value").cast("string").alias("value"), F.col("n").alias("count"))
        for rows in _counted_values(df, names, buckets, left)])


def _counted_values(
    df: DataFrame, names: Sequence[str], buckets: int, parts: DataFrame
) -> list[DataFrame]:
    """(position, value, n) of the values in the given parts, a frame for each type.

    Every column is read once, by the scan of its type.
    """
    by_type: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        by_type.setdefault(df.schema[name].dataType.json(), []).append(k)
    frames = []
    for positions in by_type.values():
        cells = F.array(*[
            F.struct(
                F.lit(k).alias("position"), named(names[k]).alias("value"),
                _bucket(names[k], buckets).alias("bucket"))
            for k in positions])
        # At most ``_COUNTED`` rows of three numbers, whatever the table holds.
        wanted = F.broadcast(parts.where(F.col("position").isin(positions)).select("position", "bucket"))
        frames.append(
            df.select(F.inline(cells)).join(wanted, ["position", "bucket"], "left_semi")
            .groupBy("position", "value").agg(F.count(F.lit(1)).alias("n")))
    return frames
