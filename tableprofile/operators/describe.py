"""Descriptive statistics.

Statistics whose state is small (a few numbers per column) are ``Measures``;
the typed operators and ``profile`` share them. The others need a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile import defaults
from tableprofile.functions.columns import (
    fixed_width,
    named,
    numeric_columns,
    percent_text,
    quoted,
    require_columns,
    rounded,
    rounded_text,
    text_literal,
    value_bytes,
)
from tableprofile.operators.measures import (
    ROW_COUNT,
    Aggregate,
    Cell,
    Measures,
    measure,
    measure_one,
)


# Basic facts


def basic_info_measures(df: DataFrame, digits: int | None = defaults.PERCENT_DIGITS) -> Measures:
    """Size is the row count times the fixed widths, plus the measured bytes of
    the values of variable width; fixed-width columns are not read at all."""
    aggregates = {"rows": ROW_COUNT}
    fixed = 0
    for position, f in enumerate(df.schema.fields):
        width = fixed_width(f.dataType)
        if width is None:
            size = value_bytes(quoted(f.name), f.dataType)
            aggregates[f"bytes_{position}"] = Aggregate(f"sum({size})")
        else:
            fixed += width
    measured = [f"coalesce({name}, 0L)" for name in aggregates if name != "rows"]
    total = " + ".join([f"rows * {fixed}L", *measured])
    numeric = len(numeric_columns(df))
    facts = {
        "num_rows": "rows",
        "num_columns": f"{len(df.columns)}",
        "numeric_columns": f"{numeric}",
        "other_columns": f"{len(df.columns) - numeric}",
        "size_bytes": total,
        "size_mb": rounded_text(f"({total}) / 1048576D", digits),
    }
    cells = [Cell(None, facts, tuple(aggregates))]
    for f in df.schema.fields:
        cells.append(Cell(f.name, {"data_type": text_literal(f.dataType.simpleString())}, ()))
    return Measures("basic_info", aggregates, tuple(cells), frozenset({"data_type"}))


def basic_info(df: DataFrame, digits: int | None = defaults.PERCENT_DIGITS) -> DataFrame:
    """Row and column counts, estimated size, and the columns with their types."""
    measures = basic_info_measures(df, digits)
    types = [x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))]
    return measure_one(df, measures, measures.cells[0]).select(
        "*",
        F.array(*[F.lit(c) for c in df.columns]).cast("array<string>").alias("column_names"),
        F.create_map(*types).cast("map<string,string>").alias("data_types"),
    )


# Summary of numeric columns


def _double(name: str) -> str:
    return f"cast({quoted(name)} as double)"


def summary_measures(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_cols: int | None = defaults.SUMMARY_COLUMNS,
) -> Measures:
    chosen = require_columns(df, columns) if columns else numeric_columns(df, max_cols)
    aggregates: dict[str, Aggregate] = {}
    cells = []
    for name in chosen:
        position, value = df.columns.index(name), _double(name)
        per_metric = {
            "min": Aggregate(f"min({value})"),
            "max": Aggregate(f"max({value})"),
            "mean": Aggregate(f"avg({value})", 2),
            "stddev": Aggregate(f"stddev_samp({value})", 3),
        }
        keyed = {f"{metric}_{position}": a for metric, a in per_metric.items()}
        aggregates.update(keyed)
        metrics = dict(zip(per_metric, keyed))
        cells.append(Cell(name, metrics, tuple(keyed)))
    message = None if chosen else defaults.NO_NUMERIC_COLUMNS
    return Measures("summary_stats", aggregates, tuple(cells), message=message)


def summary_statistics(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_cols: int | None = defaults.SUMMARY_COLUMNS,
) -> DataFrame:
    """Min, max, mean and sample standard deviation of each numeric column."""
    return measure(
        df,
        summary_measures(df, columns, max_cols),
        "column",
        "column string, min double, max double, mean double, stddev double",
    )


# Missing values


def missing_measures(df: DataFrame, digits: int | None = defaults.PERCENT_DIGITS) -> Measures:
    """Per column, then over all cells of the table (subject None)."""
    aggregates = {"rows": ROW_COUNT}
    cells = []
    counts = []
    for position, name in enumerate(df.columns):
        key = f"present_{position}"
        aggregates[key] = Aggregate(f"count({quoted(name)})")
        count = f"(rows - {key})"
        metrics = {"missing_count": count, "missing_pct": percent_text(count, "rows", digits)}
        cells.append(Cell(name, metrics, ("rows", key)))
        counts.append(count)
    total, size = " + ".join(counts) or "0L", f"rows * {len(df.columns)}L"
    overall = {
        "total_missing": total,
        "total_cells": size,
        "overall_missing_pct": percent_text(total, size, digits),
    }
    cells.append(Cell(None, overall, tuple(aggregates)))
    return Measures("missing_values", aggregates, tuple(cells))


def missing_values(df: DataFrame, digits: int | None = defaults.PERCENT_DIGITS) -> DataFrame:
    """NULL count and percentage of each column. NaN is a value, not missing."""
    both = missing_measures(df, digits)
    columns = Measures(both.section, both.aggregates, both.cells[:-1])
    schema = "column string, missing_count bigint, missing_pct double"
    return measure(df, columns, "column", schema)


def missing_overall(df: DataFrame, digits: int | None = defaults.PERCENT_DIGITS) -> DataFrame:
    """NULL count and percentage over all cells of the table."""
    measures = missing_measures(df, digits)
    return measure_one(df, measures, measures.cells[-1])


# Unique values


def approx_unique_measures(
    df: DataFrame, rsd: float = 0.05, digits: int | None = defaults.PERCENT_DIGITS
) -> Measures:
    aggregates = {"rows": ROW_COUNT}
    cells = []
    for position, name in enumerate(df.columns):
        found, present = f"distinct_{position}", f"present_{position}"
        aggregates[found] = Aggregate(f"approx_count_distinct({quoted(name)}, {rsd}D)")
        aggregates[present] = Aggregate(f"count({quoted(name)})")
        count = f"{found} + if(rows > {present}, 1, 0)"
        cells.append(Cell(name, _unique_cells(count, "rows", digits), ("rows", found, present)))
    return Measures("unique_values", aggregates, tuple(cells), together=True)


def _unique_cells(count: str, rows: str, digits: int | None) -> dict[str, str]:
    return {"unique_count": count, "unique_pct": percent_text(count, rows, digits)}


def unique_values(
    df: DataFrame,
    approx: bool = False,
    rsd: float = 0.05,
    digits: int | None = defaults.PERCENT_DIGITS,
) -> DataFrame:
    """Distinct values of each column, NULL counted as a value, and their ratio.

    The exact form unpivots the columns of each type into (position, value)
    rows and removes duplicates. Texts of 32 bytes or more are told apart by their
    SHA-256, so whole texts are never shuffled. A map task removes its own duplicates first, so
    a value held by a third of all rows reaches the shuffle once per task. Every
    column is read once, by the scan of its type. The approximate form shuffles
    one sketch per column and task.
    """
    schema = "column string, unique_count bigint, unique_pct double"
    if approx:
        return measure(df, approx_unique_measures(df, rsd, digits), "column", schema)
    if not df.columns:
        return df.sparkSession.createDataFrame([], schema)
    by_type: dict[str, list[int]] = {}
    for position, f in enumerate(df.schema.fields):
        by_type.setdefault(_common_type(f.dataType).json(), []).append(position)
    parts = [_distinct_counts(df, positions) for positions in by_type.values()]
    # One row per column comes back; folding them into one row puts a zero beside
    # the columns of an empty table.
    found = reduce(DataFrame.unionByName, parts).agg(
        F.map_from_entries(
            F.collect_list(F.struct("position", F.struct("unique_count", "rows")))
        ).alias("found")
    )
    rows = []
    for position, name in enumerate(df.columns):
        hit = f"try_element_at(found, {position})"
        count, total = (f"coalesce({hit}.{field}, 0L)" for field in ("unique_count", "rows"))
        fields = {"column": text_literal(name), **_unique_cells(count, total, digits)}
        rows.append(f"named_struct({', '.join(f"'{n}', {e}" for n, e in fields.items())})")
    return found.selectExpr(f"inline(array({', '.join(rows)}))")


def _common_type(data_type: T.DataType) -> T.DataType:
    """The type whose values a column can be compared in without any loss."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
        return T.BinaryType()
    return data_type


def _comparable(field: T.StructField) -> Column:
    """A narrow value that is equal where the column's values are."""
    kind, value = _common_type(field.dataType), named(field.name)
    if kind != field.dataType:
        value = value.cast(kind)
    if isinstance(kind, T.BinaryType):
        # Shorter values keep their bytes; a digest has 32, so the two never meet.
        digest = F.unhex(F.sha2(value, 256))
        value = F.when(F.octet_length(value) >= 32, digest).otherwise(value)
    return value


def _distinct_counts(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    cells = [
        x for p in positions for x in (F.lit(p), _comparable(df.schema.fields[p]))
    ]
    values = df.select(F.stack(F.lit(len(positions)), *cells).alias("position", "value"))
    # The copies of each value add up to the rows of the table.
    counted = values.groupBy("position", "value").agg(F.count(F.lit(1)).alias("copies"))
    return counted.groupBy("position").agg(
        F.count(F.lit(1)).alias("unique_count"), F.sum("copies").alias("rows")
    )


# Correlation


def correlation_columns(
    df: DataFrame, columns: Sequence[str] | None, max_cols: int | None
) -> list[str]:
    return require_columns(df, columns) if columns else numeric_columns(df, max_cols)


# A side whose squared deviations are this small beside its squares is constant.
_NO_SPREAD = 1e-12
_PAIR_SUMS = ("n", "odd", "sx", "sy", "sxx", "syy", "sxy")
_PAIR_FIELDS = ", ".join(f"{name} double" for name in _PAIR_SUMS)
# Sums of a scan, below the bound from which Spark generates no code, and scans at most.
_SCAN_FIELDS = 90
_SCANS = 4


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the rows where both values of a pair are present, a row per pair.

    They are products of matrices: of the values, their squares, and marks of present
    and of non-finite values.
    """
    total: list[np.ndarray] | None = None
    width = 0
    for batch in batches:
        width = batch.num_columns
        rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        here = np.column_stack([~np.asarray(c.is_null()) for c in batch.columns]).astype(float)
        finite = np.isfinite(rows)
        odd = here * ~finite
        x = np.where(finite, rows, 0.0)
        found = [here.T @ here, odd.T @ here, x.T @ here, (x * x).T @ here, x.T @ x]
        total = found if total is None else [t + f for t, f in zip(total, found)]
    if total is None:
        return
    i, j = np.triu_indices(width, 1)
    n, odd, s, ss, sxy = total
    sums = (n[i, j], odd[i, j] + odd[j, i], s[i, j], s[j, i], ss[i, j], ss[j, i], sxy[i, j])
    yield pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (i.astype(np.int64), j.astype(np.int64), *sums)],
        names=["i", "j", *_PAIR_SUMS],
    )


@dataclass(frozen=True)
class _Side:
    """A numeric column as the factors of its sums; None stands for ones or zeros."""

    mean: float
    value: Column
    present: Column | None
    odd: Column | None


@dataclass(frozen=True)
class _Centred:
    """Numeric columns, taken relative to the mean of their finite values."""

    numbers: DataFrame
    rows: int
    sides: tuple[_Side, ...]

    @classmethod
    def of(cls, numbers: DataFrame) -> _Centred:
        """One scan finds the means, and which columns hold NULL, NaN or infinity at all."""
        finite = lambda c: ~F.isnan(c) & (F.abs(c) != float("inf"))
        cells = [F.count(F.lit(1))]
        for name in numbers.columns:
            c = F.col(name)
            cells += [F.avg(F.when(finite(c), c)), F.count(c), F.count_if(~finite(c))]
        row = numbers.agg(*[c.alias(f"a{k}") for k, c in enumerate(cells)]).first()
        sides = []
        for k, name in enumerate(numbers.columns):
            mean, present, odd = row[3 * k + 1 : 3 * k + 4]
            mean = mean if mean is not None and math.isfinite(mean) else 0.0
            c = F.col(name)
            value = c - F.lit(mean)
            if odd:
                value = F.when(finite(c), value)
            if odd or present < row[0]:
                value = F.coalesce(value, F.lit(0.0))
            here = None if present == row[0] else c.isNotNull().cast("double")
            strange = F.coalesce(~finite(c), F.lit(False)).cast("double") if odd else None
            sides.append(_Side(mean, value, here, strange))
        return cls(numbers, row[0], tuple(sides))

    def narrow_sums(self) -> DataFrame | None:
        """The sums of each pair as plain aggregates; None if they take more than a few scans.

        Each sum is an entry of the Gramian of values, squares and marks. Marks of columns
        without NULL are ones, so many entries are equal, and each is summed once.
        """
        wanted: dict[tuple[str, ...], Column] = {}

        def entry(*factors: tuple[str, Column | None]) -> tuple[str, ...]:
            real = sorted(((n, c) for n, c in factors if c is not None), key=lambda x: x[0])
            key = tuple(n for n, _ in real)
            if key and key not in wanted:
                wanted[key] = reduce(lambda a, b: a * b, [c for _, c in real])
            return key

        pairs = []
        for j, y in enumerate(self.sides):
            for i, x in enumerate(self.sides[:j]):
                px, py = (f"p{i}", x.present), (f"p{j}", y.present)
                vx, vy = (f"v{i}", x.value), (f"v{j}", y.value)
                odd = [entry((f"o{i}", x.odd), py)] if x.odd is not None else []
                odd += [entry((f"o{j}", y.odd), px)] if y.odd is not None else []
                sums = (
                    entry(px, py), entry(vx, py), entry(vy, px), entry(vx, vx, py),
                    entry(vy, vy, px), entry(vx, vy))
                pairs.append((i, j, sums, odd))
                if len(wanted) > _SCANS * _SCAN_FIELDS:
                    return None
        keys, scans = list(wanted), []
        for at in range(0, len(keys), _SCAN_FIELDS):
            own = [F.sum(wanted[k]).alias(f"t{n}") for n, k in enumerate(keys[at : at + _SCAN_FIELDS])]
            names = F.array(*[f"t{n}" for n in range(len(own))])
            scans.append(self.numbers.agg(*own).select(F.lit(at).alias("at"), names.alias("sums")))
        found = {(): float(self.rows)}
        for row in reduce(DataFrame.unionByName, scans).collect():
            found.update(zip(keys[row["at"] :], (x or 0.0 for x in row["sums"])))
        rows = [
            (i, j, found[n], float(sum(found[k] for k in odd)), *[found[k] for k in rest])
            for i, j, (n, *rest), odd in pairs
        ]
        return self.numbers.sparkSession.createDataFrame(sorted(rows), f"i long, j long, {_PAIR_FIELDS}")

    def wide_sums(self) -> DataFrame:
        """The sums of each pair by products of matrices, a row for each pair and task."""
        columns = zip(self.numbers.columns, self.sides)
        shifted = self.numbers.select(*[(F.col(c) - F.lit(s.mean)).alias(c) for c, s in columns])
        return (
            shifted.mapInArrow(_pair_sums, f"i long, j long, {_PAIR_FIELDS}")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _PAIR_SUMS])
        )


def correlation(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_cols: int | None = defaults.CORRELATION_COLUMNS,
    nulls: str = "pairwise",
    digits: int | None = defaults.RATIO_DIGITS,
) -> DataFrame:
    """Pearson correlation of each pair of numeric columns (upper triangle).

    ``nulls="pairwise"`` uses the rows where both values are present, ``nulls="zero"``
    reads NULL as 0. A constant column gives NULL, NaN or infinity among the rows NaN.

    A first scan finds the mean of each column, to which values are taken relative so
    that sums of squares lose no digits. The sums of all pairs then take one scan to a
    few; where a table has too many columns for that, tasks multiply matrices, and a
    task shuffles a row for each pair, whatever its number of rows.
    """
    if nulls not in ("pairwise", "zero"):
        raise ValueError(f"Unknown null handling: {nulls}")
    chosen = correlation_columns(df, columns, max_cols)
    spark, schema = df.sparkSession, "pair string, correlation double"
    if len(chosen) < 2:
        return spark.createDataFrame([], schema)
    values = [named(c).cast("double") for c in chosen]
    if nulls == "zero":
        values = [F.coalesce(v, F.lit(0.0)) for v in values]
    numbers = df.select(*[v.alias(f"c{k}") for k, v in enumerate(values)])
    centred = _Centred.of(numbers)
    found = centred.narrow_sums()
    if found is None:
        # Tasks without rows give no sums, so the pairs are named apart.
        many = len(chosen)
        pairs = spark.range(many * many).select(
            F.floor(F.col("id") / many).alias("i"), (F.col("id") % many).alias("j")
        ).where("i < j")
        found = pairs.join(centred.wide_sums(), ["i", "j"], "left").orderBy("i", "j")
    spread = lambda s, ss: F.col(ss) - F.col(s) * F.col(s) / F.col("n")
    vx, vy = spread("sx", "sxx"), spread("sy", "syy")
    pearson = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(vx * vy)
    value = F.when(F.col("odd") > 0, float("nan")).when(
        (F.col("n") > 0) & (vx > _NO_SPREAD * F.col("sxx")) & (vy > _NO_SPREAD * F.col("syy")),
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), pearson)),
    )
    names = F.array(*[F.lit(c) for c in chosen])
    name = lambda c: F.get(names, F.col(c).cast("int"))
    return found.select(
        F.concat(name("i"), F.lit(" vs "), name("j")).alias("pair"),
        rounded(value, digits).alias("correlation"),
    )


# Value counts


def value_counts(df: DataFrame, column: str, top_n: int | None = defaults.TOP_VALUES) -> DataFrame:
    """The most frequent values of a column; equal counts in value order.

    NULL is a value of its own and sorts first among equals.
    """
    require_columns(df, [column])
    counted = df.groupBy(named(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    ranked = counted.orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return ranked if top_n is None else ranked.limit(top_n)
