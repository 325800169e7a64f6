"""Spectrum slicing against numpy's own eigenvalues, whitening against its formulas."""

from __future__ import annotations

import numpy as np
import pytest

from tableprofile.llm.whitening import Slicer, counted_in_tasks, inertia, leading, whiten


def whole(entries):
    return np.floor(64 * np.asarray(entries, dtype=np.float64)).astype(np.int64) + 1_000_000


def test_inertia_equals_signs_of_eigenvalues():
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.integers(1, 14))
        m = rng.normal(size=(n, n))
        m = m + m.T
        if rng.random() < 0.5:
            m = np.round(m)
        if rng.random() < 0.4:
            np.fill_diagonal(m, 0)
        values = np.linalg.eigvalsh(m)
        positive, zero, negative = inertia(m)
        assert positive + zero + negative == n
        if np.abs(values).min() > 1e-9:
            assert (positive, negative) == ((values > 0).sum(), (values < 0).sum())


@pytest.mark.parametrize("values", [
    [9, 4, 1, 0.5], [5, 5, 5, 3, 3, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.2], [1e6, 1, 1e-3], [2], [3, 3],
    [7, 1e-16, 0, 0], np.linspace(1, 2, 40),
])
def test_leading_pairs(values):
    rng = np.random.default_rng(2)
    values = np.sort(np.asarray(values, dtype=float))[::-1]
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    m = q * values @ q.T
    m = (m + m.T) / 2
    found = leading(m, 32)
    rank = min(32, int((values > 1e-13 * values[0]).sum()))
    assert len(found.values) == rank
    assert np.allclose(found.values, values[:rank], rtol=0, atol=1e-13 * values[0])
    v = found.vectors
    assert np.allclose(v.T @ v, np.eye(rank), atol=1e-12)
    assert np.allclose(m @ v, v * found.values, atol=1e-12 * values[0])


def test_slices_hold_one_eigenvalue_each(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 12))
    m = np.cov(x.T, bias=True)
    slicer = Slicer(m, counted_in_tasks(spark, m))
    values = np.linalg.eigvalsh(m)[::-1]
    assert slicer.isolate(5) == 5
    for number in range(1, 6):
        low, high = slicer.slice_of(number)
        assert [v for v in values if low < v <= high] == [values[number - 1]]
    assert all(slicer.certified(values[:5].tolist()))
    assert not slicer.certified([values[1]])[0]  # it is the second, not the first


def check(rows, vectors, components):
    """Rows of whiten() against plain formulas; ``vectors`` by id."""
    ids = sorted(vectors)
    x = whole([vectors[i] for i in ids])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == n * components
    z = np.array([[got[i, k + 1]["whitened"] for k in range(components)] for i in ids])
    wanted = centred @ q[:, :components] / np.sqrt(e[:components])
    sign = np.sign((z * wanted).sum(axis=0))
    assert np.allclose(z, wanted * sign, atol=1e-6)
    error = np.abs(np.cov(z.T, bias=True).reshape(components, components) - np.eye(components)).max()
    for i, own in zip(ids, x.tolist()):
        r = got[i, 1]
        assert r["n"] == n
        assert r["deviation"] == sum((n * a - int(s)) ** 2 for a, s in zip(own, sums))
        assert abs(r["explained"] - e[0] / e.sum()) < 1e-10
        assert abs(r["identity_error"] - error) < 1e-9


def test_whitening_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in table.collect()}
    check(whiten(table.repartition(5)).collect(), vectors, 32)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [2.0, -1.0]), (3, [0.0, 5.5]), (4, None), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (10, [0.0, 5.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    kept = {i: v for i, v in rows if i in (1, 2, 3, 10)}
    check(whiten(df).collect(), kept, 2)


def test_tables_without_spread(spark):
    schema = "vec_id long, embedding array<float>, component string, n int"
    for rows in ([], [(1, [1.0, 2.0], "a", 1)], [(k, [1.0, 2.0], "a", 1) for k in range(5)]):
        assert whiten(spark.createDataFrame(rows, schema)).count() == 0
    flat = spark.createDataFrame([(k, [float(k), 1.0], "a", 1) for k in range(5)], schema)
    assert {r["component"] for r in whiten(flat).collect()} == {1}
    assert whiten(flat, keep=("vec_id", "component")).columns[:2] == ["vec_id", "component"]


def test_far_and_huge_entries(spark):
    rng = np.random.default_rng(5)
    far = {k: (1e6 + rng.normal(size=3)).tolist() for k in range(50)}
    df = spark.createDataFrame(list(far.items()), "vec_id long, embedding array<double>")
    check(whiten(df).collect(), far, 3)
    huge = spark.createDataFrame(
        [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    rows = whiten(huge).collect()
    far_off = {r["vec_id"] for r in rows if r["deviation"] is None}
    assert far_off == {1, 2} and all(np.isfinite(r["whitened"]) for r in rows)
