"""Statistics with small state, as aggregates over a table and cells over them.

Both are SQL text. A wide table needs thousands of small expressions, and Spark
parses them much faster than Python can build them call by call.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from tableprofile.functions.columns import quoted, text_literal
from tableprofile.functions.tidy import TIDY_SCHEMA, tidy_cell

# Spark generates code only for operators of up to 100 fields
# (spark.sql.codegen.maxFields); beyond that a row costs several times as much.
MAX_STATE_FIELDS = 100


@dataclass(frozen=True)
class Aggregate:
    """One aggregate and the number of fields its running state takes."""

    expression: str
    fields: int = 1


ROW_COUNT = Aggregate("count(1)")


@dataclass(frozen=True)
class Cell:
    """The metrics of one subject (a column, a pair, or None for the table).

    ``metrics`` are expressions over the aggregates named in ``needs``.
    """

    subject: str | None
    metrics: dict[str, str]
    needs: tuple[str, ...]


@dataclass(frozen=True)
class Measures:
    """One statistic. Metrics in ``texts`` hold strings, all others numbers.

    ``together`` keeps all cells in one scan even beyond the field limit, for
    aggregates whose state is a sketch of many fields anyway.
    """

    section: str
    aggregates: dict[str, Aggregate]
    cells: tuple[Cell, ...]
    texts: frozenset[str] = frozenset()
    message: str | None = None
    together: bool = False


@dataclass
class _Scan:
    """Cells computed by one aggregation over the table."""

    aggregates: dict[str, Aggregate]
    cells: list[tuple[Measures, Cell]]
    closed: bool = False

    def fields_with(self, more: dict[str, Aggregate]) -> int:
        return sum(a.fields for a in {**self.aggregates, **more}.values())


def _scans(several: Sequence[Measures]) -> list[_Scan]:
    """Spread the cells over as few scans as the field limit allows, in order.

    Each scan reads only the columns its own aggregates use, so several scans of
    a columnar table read hardly more than one.
    """
    scans: list[_Scan] = []
    for measures in several:
        if measures.together:
            cells = [(measures, cell) for cell in measures.cells]
            scans.append(_Scan(dict(measures.aggregates), cells, closed=True))
            continue
        for cell in measures.cells:
            more = {name: measures.aggregates[name] for name in cell.needs}
            for scan in scans:
                if not scan.closed and scan.fields_with(more) <= MAX_STATE_FIELDS:
                    break
            else:
                scan = _Scan({}, [])
                scans.append(scan)
            scan.aggregates.update(more)
            scan.cells.append((measures, cell))
    return scans


def _totals(df: DataFrame, aggregates: dict[str, Aggregate]) -> DataFrame:
    """One row; a scan of literals only still counts the rows."""
    chosen = aggregates or {"rows": ROW_COUNT}
    return df.selectExpr(*[f"{a.expression} as {name}" for name, a in chosen.items()])


def _inlined(df: DataFrame, scan: _Scan, rows: Sequence[str]) -> DataFrame:
    return _totals(df, scan.aggregates).selectExpr(f"inline(array({', '.join(rows)}))")


def measure(df: DataFrame, measures: Measures, subject: str, schema: str) -> DataFrame:
    """Typed result of one statistic: one row per subject."""
    parts = []
    for scan in _scans([measures]):
        rows = []
        for _, cell in scan.cells:
            fields = {subject: text_literal(cell.subject), **cell.metrics}
            named_fields = ", ".join(f"{text_literal(n)}, {e}" for n, e in fields.items())
            rows.append(f"named_struct({named_fields})")
        parts.append(_inlined(df, scan, rows))
    if not parts:
        return df.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def measure_one(df: DataFrame, measures: Measures, cell: Cell) -> DataFrame:
    """Typed result of one cell, without its subject."""
    needed = {name: measures.aggregates[name] for name in cell.needs}
    return _totals(df, needed).selectExpr(
        *[f"{e} as {quoted(m)}" for m, e in cell.metrics.items()]
    )


def measure_tidy(df: DataFrame, several: Sequence[Measures]) -> DataFrame:
    """Tidy result of several statistics in as few scans as possible."""
    parts = []
    for scan in _scans(several):
        rows = [
            tidy_cell(m.section, cell.subject, metric, value, metric in m.texts)
            for m, cell in scan.cells
            for metric, value in cell.metrics.items()
        ]
        parts.append(_inlined(df, scan, rows))
    messages = [(m.section, None, "message", None, m.message) for m in several if m.message]
    if messages or not parts:
        parts.append(df.sparkSession.createDataFrame(messages, TIDY_SCHEMA))
    return reduce(DataFrame.unionByName, parts)
