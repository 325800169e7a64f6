"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers, so that sums are exact whatever the order of rows: one pass
of Spark adds up the vectors, a second one the products of deviations from a whole centre
near the mean. Their covariance has a row per dimension, whatever the number of vectors.

The leading eigenvalues are found by slicing the spectrum: the signs of D in a pivoted
LDL' factorisation of the covariance less a shift count the eigenvalues above the shift.
Slices with several are cut on, their shifts being counted by Spark tasks, until each
leading eigenvalue is alone. Rayleigh quotient iteration, started from
the middle of its slice, then converges cubically to the eigenvalue and its vector, and
counts on both sides of the result certify its number. Eigenvalues too close to be told
apart share a slice; their vectors are made orthogonal to each other.

A third pass measures the covariance of the whitened vectors, and a last one writes them.

Vectors that are null or hold null or non-finite entries are left out, and so are vectors
of another width than the commonest (the widest of equals). Entries beyond 2 ** 46 count
as that, so that whole numbers stay exact. Equal vectors get equal rows, ids may be null
or repeated. Directions without variance cannot be whitened: components end before them,
so a table without two different vectors gives no rows, nor does an empty one. A
``deviation`` too large for a long is null. Kept columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprofile.llm.shared import unused

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
LARGEST = 2.0**46
ROWS = 4096
CUTS = 8  # parts of a slice that still holds several eigenvalues
ITERATIONS = 30
CLOSE = 1e-3  # gaps below this share of the largest value need vectors kept apart

FIELDS = "component int, n long, deviation long, whitened double, explained double, " \
    "identity_error double"


# Spectrum slicing.

_GOLDEN = (1 + 17**0.5) / 8  # the pivot bound of Bunch and Kaufman


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Positive, zero and negative eigenvalues, from a symmetrically pivoted LDL'.

    Pivots are single entries or blocks of two, so the factorisation exists and is stable
    for any symmetric matrix; by Sylvester's law the signs of D are those of the matrix.
    """
    a = np.array(matrix, dtype=np.float64)
    positive = zero = negative = 0
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        below = column[r - 1] if r else 0.0
        if max(abs(a[0, 0]), below) == 0.0:
            zero, a = zero + 1, a[1:, 1:]
            continue
        size = 1
        if abs(a[0, 0]) < _GOLDEN * below:
            others = np.abs(a[r])
            others[r] = 0.0
            across = others.max()
            if abs(a[0, 0]) * across >= _GOLDEN * below**2:
                pass
            elif abs(a[r, r]) >= _GOLDEN * across:
                a[[0, r]] = a[[r, 0]]
                a[:, [0, r]] = a[:, [r, 0]]
            else:
                size = 2
                a[[1, r]] = a[[r, 1]]
                a[:, [1, r]] = a[:, [r, 1]]
        if size == 1:
            pivot = a[0, 0]
            positive, negative = positive + (pivot > 0), negative + (pivot < 0)
            left = a[1:, 0]
            a = a[1:, 1:] - np.outer(left, left / pivot)
        else:
            # Such a block has one eigenvalue of each sign.
            positive, negative = positive + 1, negative + 1
            p, q, s = a[0, 0], a[1, 1], a[1, 0]
            d = (p / s) * (q / s) - 1.0
            u, v = a[2:, 0] / s, a[2:, 1] / s
            x, y = (q / s * u - v) / d, (p / s * v - u) / d
            a = a[2:, 2:] - (np.outer(a[2:, 0], x) + np.outer(a[2:, 1], y))
    return int(positive), zero, int(negative)


def above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues larger than the shift."""
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


@dataclass(frozen=True)
class Eigen:
    """Leading eigenvalues, falling, and their unit vectors as columns."""

    values: np.ndarray
    vectors: np.ndarray


Counts = Callable[[Sequence[float]], list[int]]


class Slicer:
    """Leading eigenpairs of a symmetric matrix without negative eigenvalues.

    ``count`` gives, for some shifts, the numbers of eigenvalues above them.
    """

    def __init__(self, matrix: np.ndarray, count: Counts | None = None):
        self.matrix = np.asarray(matrix, dtype=np.float64)
        self.size = len(self.matrix)
        self.count = count or (lambda shifts: [above(self.matrix, s) for s in shifts])
        # No eigenvalue is larger than the largest sum of a row.
        self.top = float(np.abs(self.matrix).sum(axis=1).max(initial=0.0))
        # Eigenvalues nearer than this cannot be told apart.
        self.blur = 4 * np.finfo(float).eps * self.top * max(1, self.size) ** 0.5
        self.counts = {-self.top - self.blur: self.size, self.top * 1.01 + self.blur: 0}

    def learn(self, shifts: Iterable[float]) -> None:
        new = sorted({float(s) for s in shifts} - self.counts.keys())
        self.counts.update(zip(new, self.count(new)))

    def isolate(self, components: int) -> int:
        """Cut the spectrum until the leading eigenvalues are alone; how many there are."""
        # What rounding may leave in a direction without variance.
        least = 32 * self.size * np.finfo(float).eps * self.top
        self.learn([least])
        wanted = min(components, self.counts[least])
        while True:
            points = sorted(self.counts)
            new: list[float] = []
            for low, high in zip(points, points[1:]):
                inside = self.counts[low] - self.counts[high]
                if inside > 1 and self.counts[high] < wanted and high - low > self.blur:
                    new += [low + (high - low) * k / CUTS for k in range(1, CUTS)]
            if not new:
                return wanted
            self.learn(new)

    def slice_of(self, number: int) -> tuple[float, float]:
        """(low, high) around the eigenvalue of that number, counted from 1."""
        low = max(s for s, n in self.counts.items() if n >= number)
        high = min(s for s, n in self.counts.items() if n < number)
        return low, high

    def pair(self, number: int, near: np.ndarray) -> tuple[float, np.ndarray]:
        """The eigenpair of that number, orthogonal to the columns of ``near``.

        The quotient must stay in the slice; where it leaves, the slice is halved and
        the iteration starts again from its middle.
        """
        while True:
            low, high = self.slice_of(number)
            value, vector = self._iterate((low + high) / 2, near)
            if low - self.blur <= value <= high + self.blur or high - low <= self.blur:
                return value, vector
            self.learn([(low + high) / 2])

    def certified(self, values: Sequence[float]) -> list[bool]:
        """Whether counts on both sides of each value say that it has its number."""
        width = [max(self.blur, 1e-13 * abs(v)) for v in values]
        self.learn([v + s * w for v, w in zip(values, width) for s in (1, -1)])
        return [
            self.counts[v + w] < number <= self.counts[v - w]
            for number, (v, w) in enumerate(zip(values, width), 1)
        ]

    def _iterate(self, shift: float, near: np.ndarray) -> tuple[float, np.ndarray]:
        # The same start every time, in no special direction.
        vector = self._apart(np.cos(1.0 + np.arange(self.size, dtype=np.float64) ** 2), near)
        for _ in range(2):  # inverse iteration from the middle of the slice
            vector = self._apart(self._solve(shift, vector), near)
        value, best = float(vector @ self.matrix @ vector), np.inf
        kept = value, vector
        for _ in range(ITERATIONS):
            left = float(np.linalg.norm(self.matrix @ vector - value * vector))
            if left >= 0.5 * best:
                break
            best, kept = left, (value, vector)
            vector = self._apart(self._solve(value, vector), near)
            value = float(vector @ self.matrix @ vector)
        return kept

    def _solve(self, shift: float, vector: np.ndarray) -> np.ndarray:
        step = self.matrix - shift * np.eye(self.size)
        try:
            found = np.linalg.solve(step, vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            found = np.linalg.solve(step + self.blur * np.eye(self.size), vector)
        return found / np.linalg.norm(found)

    @staticmethod
    def _apart(vector: np.ndarray, near: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - near @ (near.T @ vector)
        return vector / np.linalg.norm(vector)


def leading(matrix: np.ndarray, components: int, count: Counts | None = None) -> Eigen:
    """The leading eigenpairs, at most as many as the matrix has rank."""
    slicer = Slicer(matrix, count)
    if slicer.top == 0.0:
        return Eigen(np.empty(0), np.empty((slicer.size, 0)))
    wanted = slicer.isolate(components)
    values, vectors = np.zeros(wanted), np.zeros((slicer.size, wanted))

    def find(k: int) -> None:
        # Vectors of close eigenvalues are not orthogonal by themselves.
        close = [i for i in range(k) if values[i] - slicer.slice_of(k + 1)[1] <= CLOSE * slicer.top]
        values[k], vectors[:, k] = slicer.pair(k + 1, vectors[:, close])

    for k in range(wanted):
        find(k)
    for k, fine in enumerate(slicer.certified(values.tolist())):
        if not fine:
            # Narrow the slice as far as rounding allows, and start from there.
            while True:
                low, high = slicer.slice_of(k + 1)
                if high - low <= slicer.blur:
                    break
                slicer.learn([(low + high) / 2])
            find(k)
    return Eigen(values, vectors)


def counted_in_tasks(spark: SparkSession, matrix: np.ndarray) -> Counts:
    """Counts of the eigenvalues above shifts, a task for some shifts each.

    The matrix is broadcast: a number for each two dimensions, whatever the rows.
    """
    sent = spark.sparkContext.broadcast(matrix)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [above(sent.value, s) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int32())], names=["at", "found"])

    def counts(shifts: Sequence[float]) -> list[int]:
        if not shifts:
            return []
        parts = min(len(shifts), spark.sparkContext.defaultParallelism)
        rows = spark.createDataFrame(list(enumerate(shifts)), "at int, shift double")
        found = rows.repartition(parts, "at").mapInArrow(count, "at int, found int").collect()
        return [r["found"] for r in sorted(found, key=lambda r: r["at"])]

    return counts


# The passes over the vectors.


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of the fitted vectors."""

    n: int
    sums: tuple[int, ...]
    centre: np.ndarray  # whole numbers next to the mean
    rest: np.ndarray  # the mean less the centre
    eigen: Eigen
    trace: float

    def apply(self, whole: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole vectors (rows), one column per component."""
        deviation = (whole - self.centre).astype(np.float64) - self.rest
        return deviation @ self.eigen.vectors / np.sqrt(self.eigen.values)

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """Exact sums of squares of n times the deviation from the mean."""
        rest = np.array([s - c * self.n for s, c in zip(self.sums, self.centre.tolist())], dtype=object)
        near = whole - self.centre
        rough = float(np.abs(near).max(initial=0)) + 1.0
        if (rough * self.n) ** 2 * max(1, whole.shape[1]) < 2.0**62:
            exact = near * self.n - rest.astype(np.int64)
            return (exact * exact).sum(axis=1).tolist()
        exact = near.astype(object) * self.n - rest
        found = [int(x) for x in (exact * exact).sum(axis=1)]
        return [x if x < 2**63 else None for x in found]


def usable(vector: Column) -> Column:
    """True for a vector whose entries are all finite numbers."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def _whole(column: pa.Array, width: int) -> np.ndarray:
    """The whole numbers of a list column, one row per vector."""
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.clip(SCALE * entries, -SCALE * LARGEST, SCALE * LARGEST)
    return (np.floor(scaled).astype(np.int64) + SHIFT).reshape(-1, width)


def _sums(rows: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                whole = _whole(batch.column(0).slice(start, ROWS), width)
                n += len(whole)
                total = [t + int(s) for t, s in zip(total, whole.sum(axis=0))]
        at = pa.array(range(width), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [at, pa.array([n] * width), pa.array(total, pa.decimal128(38, 0))],
            names=["i", "n", "total"])

    found = rows.mapInArrow(add, "i int, n long, total decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    return int(found[0]["n"]), tuple(int(r["total"]) for r in found)


def _products(rows: DataFrame, width: int, map_rows, size: int) -> np.ndarray:
    """Sums of products of the columns ``map_rows`` makes of the whole vectors."""
    i, j = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                x = map_rows(_whole(batch.column(0).slice(start, ROWS), width))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
            names=["i", "j", "total"])

    found = rows.mapInArrow(add, "i int, j int, total double").groupBy("i", "j").agg(
        F.sum("total").alias("total")).toPandas()
    matrix = np.zeros((size, size))
    matrix[found["i"], found["j"]] = matrix[found["j"], found["i"]] = found["total"]
    return matrix


def fit_whitening(
    vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Whitening | None]:
    """The rows that take part, and the whitening fitted to all of them."""
    fine = vectors.where(usable(F.col(vector)))
    widths = fine.groupBy(F.size(vector).alias("width")).count()
    commonest = widths.orderBy(F.desc("count"), F.desc("width")).first()
    if commonest is None:
        return fine, None
    width = commonest["width"]
    rows = fine.where(F.size(vector) == width)
    own = rows.select(vector)
    n, sums = _sums(own, width)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    rest = np.array([(s - c * n) / n for s, c in zip(sums, centre.tolist())])
    products = _products(own, width, lambda w: (w - centre).astype(np.float64), width)
    # Deviations from the centre are whole; the mean lies within half a unit of it.
    covariance = products / n - np.outer(rest, rest)
    eigen = leading(covariance, components, counted_in_tasks(vectors.sparkSession, covariance))
    return rows, Whitening(n, sums, centre, rest, eigen, float(np.trace(covariance)))


def whiten(
    vectors: DataFrame,
    vector: str = "embedding",
    keep: Sequence[str] = ("vec_id",),
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per vector and component: the kept columns, then ``FIELDS``.

    ``explained`` is the component's share of the variance, and ``identity_error`` the
    largest entry of the whitened vectors' measured covariance less the identity.
    """
    fields = T._parse_datatype_string(FIELDS).fields
    schema = T.StructType([*[vectors.schema[c] for c in keep], *fields])
    rows, fitted = fit_whitening(vectors, vector, components)
    size = 0 if fitted is None else len(fitted.eigen.values)
    if not size:
        return vectors.sparkSession.createDataFrame([], schema)
    width = len(fitted.sums)
    own = rows.select(vector)
    # A column of ones gives the means of the whitened vectors along with their products.
    measured = _products(
        own, width, lambda w: np.column_stack([fitted.apply(w), np.ones(len(w))]), size + 1)
    mean = measured[:size, size] / fitted.n
    error = float(np.abs(
        measured[:size, :size] / fitted.n - np.outer(mean, mean) - np.eye(size)).max())
    explained = fitted.eigen.values / fitted.trace
    names, place = schema.names, unused("_vector", keep)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                whole = _whole(part.column(part.num_columns - 1), width)
                count = len(whole)
                again = pa.array(np.repeat(np.arange(count), size))
                spread = pa.array(fitted.deviations(whole), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i).take(again) for i in range(len(keep))],
                     pa.array(np.tile(np.arange(1, size + 1), count), pa.int32()),
                     pa.array(np.full(count * size, fitted.n)),
                     spread.take(again),
                     pa.array(fitted.apply(whole).ravel()),
                     pa.array(np.tile(explained, count)),
                     pa.array(np.full(count * size, error))],
                    names=names)

    return rows.select(*keep, F.col(vector).alias(place)).mapInArrow(write, schema)
