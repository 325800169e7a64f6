"""Medians and quantiles of columns, exact or approximate."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from decimal import Decimal
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile import defaults
from tableprofile.functions.blocks import over_blocks, packed
from tableprofile.functions.columns import as_double, is_missing_number, named, require_columns
from tableprofile.operators.features import working_set

_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY
# Parts a bracket is divided into by a round of exact quantiles.
_PARTS = 1024
# Brackets counted in one scan: a task holds a count, a least and a largest value of each part.
_BRACKETS = 4096


def approx_median(
    df: DataFrame, column: str, relative_error: float = defaults.MEDIAN_RELATIVE_ERROR
) -> float | None:
    """A value whose rank is within ``relative_error`` of the middle."""
    require_columns(df, [column])
    found = df.approxQuantile(column, [0.5], relative_error)
    return found[0] if found else None


def exact_median(df: DataFrame, column: str) -> float | int | Decimal | None:
    """The lower median: the smallest value with at least half of all below or at it.

    NULL and NaN are ignored; None if nothing is left. Whole and decimal numbers keep
    their type and all their digits. Each round brackets the
    middle rank with bounded quantile sketches, then counts exactly how many
    values lie on each side, so no task ever holds the distinct values of the
    column. A round keeps about one value in 2,500, so even 10^12 rows need about
    four.
    """
    require_columns(df, [column])
    value = F.col("value")
    exact = isinstance(
        df.schema[column].dataType,
        (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType),
    )
    inside = df.select((named(column) if exact else as_double(column)).alias("value"))
    inside = inside.filter(value.isNotNull() if exact else ~is_missing_number(value))
    rank = total = None
    while True:
        middle = 0.5 if rank is None else (rank - 0.5) / total
        at = [max(0.0, middle - _MARGIN), min(1.0, middle + _MARGIN)]
        sketch = inside.agg(
            F.count(value).alias("n"),
            F.min(value).alias("least"),
            F.max(value).alias("most"),
            F.percentile_approx(value, at, _ACCURACY).alias("bracket"),
        ).first()
        if rank is None:
            total = sketch["n"]
            if total == 0:
                return None
            rank = (total + 1) // 2
        # A sketch holds doubles, which can miss whole numbers beyond 2^53 by a little.
        low, high = (
            max(sketch["least"], min(sketch["most"], x)) for x in sketch["bracket"]
        )
        seen = inside.agg(
            F.count_if(value < low).alias("under_low"),
            F.count_if(value <= low).alias("to_low"),
            F.count_if(value < high).alias("under_high"),
            F.count_if(value <= high).alias("to_high"),
        ).first()
        if seen["under_low"] < rank <= seen["to_low"]:
            return low
        if seen["under_high"] < rank <= seen["to_high"]:
            return high
        if rank <= seen["under_low"]:
            inside, total = inside.filter(value < low), seen["under_low"]
        elif rank > seen["to_high"]:
            inside = inside.filter(value > high)
            rank, total = rank - seen["to_high"], total - seen["to_high"]
        else:
            inside = inside.filter((value > low) & (value < high))
            rank -= seen["to_low"]
            total = seen["under_high"] - seen["to_low"]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float | Fraction]
) -> dict[str, list[float]]:
    """The lower quantiles of several columns at once, as doubles, by rising share.

    For a share ``s`` of ``n`` values, the smallest value with at least ``s * n`` of them
    below or at it. NULL and NaN are ignored; a column without values has no quantiles.

    Each round counts the rows of 1024 parts of the brackets that still hold a wanted rank,
    for all columns in one aggregate, and goes on in the parts that hold one, within their
    least and largest value. Counts merge in any order, so the result does not depend on
    partitioning; state is bounded by columns times shares, whatever the rows.
    """
    names = require_columns(df, columns)
    if not names:
        return {}
    with working_set(packed(df.select(*[as_double(c) for c in names]))) as blocks:
        found = block_quantiles(blocks, len(names), range(len(names)), shares)
    return {name: found[i] for i, name in enumerate(names)}


def block_quantiles(
    blocks: DataFrame, width: int, columns: Sequence[int], shares: Sequence[float | Fraction]
) -> dict[int, list[float]]:
    """``exact_quantiles`` of the numbered columns of blocks of ``width`` columns."""
    places = [Fraction(s) for s in sorted(shares)]
    whole = []
    if columns:
        parts = _counted_parts(blocks, width, {at: [(-math.inf, math.inf)] for at in columns})
        whole = parts.groupBy("at").agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    ranks = {r["at"]: [max(1, math.ceil(s * r["n"])) for s in places] for r in whole}
    # A bracket: the column, its least and largest value and the rows below it.
    brackets = [(r["at"], r["lo"], r["hi"], 0, r["n"]) for r in whole]
    found: dict[tuple[int, int], float] = {}
    while brackets:
        still = []
        for at, lo, hi, below, n in brackets:
            held = sorted({r for r in ranks[at] if below < r <= below + n})
            if lo == hi:
                found.update({(at, r): lo for r in held})
            else:
                still.append((at, lo, hi, below, held))
        brackets = [
            (r["at"], r["lo"], r["hi"], r["below"], r["n"]) for r in _divided(blocks, width, still)
        ]
    return {at: [found[at, r] for r in ranks.get(at, [])] for at in columns}


def _divided(blocks: DataFrame, width: int, brackets: list[tuple]) -> list[Row]:
    """The parts of the brackets that hold a wanted rank."""
    if not brackets:
        return []
    ends, wanted = {}, []
    for at in sorted({b[0] for b in brackets}):
        own = sorted(b for b in brackets if b[0] == at)
        ends[at] = [(low, high) for _, low, high, _, _ in own]
        wanted += [(at, i, below, held) for i, (_, _, _, below, held) in enumerate(own)]
    spark = blocks.sparkSession
    open_ones = spark.createDataFrame(wanted, "at int, bracket int, under long, held array<long>")
    parts = _counted_parts(blocks, width, ends).groupBy("at", "bracket", "part").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    before = F.sum("n").over(
        Window.partitionBy("at", "bracket").orderBy("part")) - F.col("n")
    placed = parts.withColumn("before", before).join(open_ones, ["at", "bracket"])
    below = F.col("under") + F.col("before")
    hit = F.exists("held", lambda r: (r > below) & (r <= below + F.col("n")))
    return placed.filter(hit).select("at", "lo", "hi", below.alias("below"), "n").collect()


def _counted_parts(
    blocks: DataFrame, width: int, ends: dict[int, list[tuple[float, float]]]
) -> DataFrame:
    """Rows, least and largest value of the parts of each column's rising brackets, by task."""
    groups: list[dict] = [{}]
    for at, own in ends.items():
        if groups[-1] and sum(map(len, groups[-1].values())) + len(own) > _BRACKETS:
            groups.append({})
        groups[-1][at] = own
    return reduce(DataFrame.unionAll, [_scanned_parts(blocks, width, own) for own in groups])


def _scanned_parts(
    blocks: DataFrame, width: int, ends: dict[int, list[tuple[float, float]]]
) -> DataFrame:
    limits = {at: np.array(own).T for at, own in ends.items()}
    each = _PARTS + 2

    def count(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells = {at: len(own) * each for at, own in ends.items()}
        sizes = {at: np.zeros(n, dtype=np.int64) for at, n in cells.items()}
        least = {at: np.full(n, math.inf) for at, n in cells.items()}
        most = {at: np.full(n, -math.inf) for at, n in cells.items()}
        for block in arrays:
            for at, (lows, highs) in limits.items():
                x = block[at]
                bracket = np.searchsorted(lows, x, side="right") - 1
                inside = (bracket >= 0) & (x <= highs[bracket])
                x, bracket = x[inside], bracket[inside]
                cell = bracket * each + _part(x, lows[bracket], highs[bracket]) + 1
                sizes[at] += np.bincount(cell, minlength=cells[at])
                np.minimum.at(least[at], cell, x)
                np.maximum.at(most[at], cell, x)
        for at, size in sizes.items():
            cell = np.flatnonzero(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cell), at), pa.int32()), pa.array(cell // each, pa.int32()),
                 pa.array(cell % each - 1, pa.int32()), pa.array(size[cell]),
                 pa.array(least[at][cell]), pa.array(most[at][cell])],
                names=["at", "bracket", "part", "n", "lo", "hi"],
            )

    return over_blocks(
        blocks, width, np.float64, count,
        "at int, bracket int, part int, n long, lo double, hi double")


def _part(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The part of its bracket a value lies in; its ends have parts of their own.

    Halves keep the width of a bracket finite. Between infinite ends all finite values
    lie in one part, whose ends the next round divides.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        half = np.where(np.abs(high - low) == math.inf, 0.5, 1.0)
        share = (x * half - low * half) / (high * half - low * half)
    part = np.minimum(np.floor(np.where(np.isnan(share), 0.0, share) * _PARTS), _PARTS - 1)
    return np.where(x == low, -1, np.where(x == high, _PARTS, part)).astype(np.int64)
