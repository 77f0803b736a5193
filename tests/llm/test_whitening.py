from fractions import Fraction

import numpy as np
import pytest

from tellerbook.llm import exact
from tellerbook.llm.queries import op13_embedding_whitening
from tellerbook.llm.whitening import characteristic_polynomial, moments, products, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, extra string"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], i % 3, "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).withColumnRenamed("extra", "x")


def whole(vectors):
    return np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000


def expanded(roots):
    out = [1]
    for r in roots:
        out = [a - r * b for a, b in zip([*out, 0], [0, *out], strict=True)]
    return out


def test_polynomial_equals_cofactors(spark, random):
    for d in (1, 2, 5, 8):
        b = random.integers(-50, 50, (d, d + 1))
        m = (b @ b.T).astype(object).tolist()
        # Faddeev and LeVerrier, in fractions.
        a = np.array([[Fraction(int(x)) for x in row] for row in m], object)
        c, k = [Fraction(1)], np.zeros((d, d), object)
        eye = np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], object)
        for i in range(1, d + 1):
            k = a.dot(k) + c[-1] * eye
            c.append(-a.dot(k).trace() / i)
        assert characteristic_polynomial(spark, m) == c
        assert exact.coefficient_bound(m) >= max(abs(x) for x in c)


def test_hessenberg_needs_pivots():
    m = [[0, 0, 0, 1], [0, 0, 1, 0], [0, 1, 0, 0], [1, 0, 0, 0]]
    p = exact.primes_for(10)[0]
    assert exact.polynomial_modulo(m, p) == [x % p for x in (1, 0, -2, 0, 1)]


def test_roots_are_isolated_exactly():
    roots = [10**12, 10**12 - 1, 77, 77, 77, 3, 0, 0]
    p = expanded(roots)
    assert [exact.roots_above(p, t) for t in (-1, 0, 3, 76, 77, 10**12 - 1, 10**12)] == [8, 6, 5, 5, 2, 1, 0]
    found = exact.largest_roots(p, 8, sum(roots))
    assert found == [(r << exact.GRID, m) for r, m in [(10**12, 1), (10**12 - 1, 1), (77, 3), (3, 1)]]
    # x^2 - 3 x + 1: irrational roots, to the last digit of the grid.
    (high, _), (low, _) = exact.largest_roots([1, -3, 1], 2, 3)
    for root in (high, low):
        x, y = (Fraction(v, 1 << exact.GRID) for v in (root - 1, root))
        assert (x * x - 3 * x + 1) * (y * y - 3 * y + 1) <= 0


def test_products_of_any_size(random):
    for bits in (3, 17, 20, 40, 61):
        x = random.integers(-(1 << bits), 1 << bits, (50, 3))
        o = x.astype(object)
        assert (products(x) == o.T.dot(o)).all()


def test_moments_do_not_depend_on_partitions(spark, random):
    x = random.integers(-(1 << 50), 1 << 50, (200, 3))
    rows = spark.createDataFrame([(v,) for v in x.tolist()], "x array<long>")
    o = x.astype(object)
    for parts in (1, 7):
        found = moments(rows.repartition(parts))
        assert found.n == 200 and found.sums == o.sum(axis=0).tolist() and found.products == o.T.dot(o).tolist()


def check(rows, vectors, k):
    x = whole([v for v in vectors])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    assert len(rows) == len(x)
    white = np.zeros((len(x), k))
    for r in rows:
        assert r.n == n and len(r.whitened) == k
        y = n * x[r.vec_id].astype(object) - s.astype(object)
        assert int(r.deviation) == int((y * y).sum())
        white[r.vec_id] = r.whitened
        np.testing.assert_allclose(r.explained, e[:k] / e.sum(), rtol=1e-9)
    expected = (x - s / n) @ v[:, :k] / np.sqrt(e[:k])
    signs = np.sign((expected * white).sum(axis=0))
    np.testing.assert_allclose(white, expected * signs, atol=1e-7)
    _, first = np.unique(x, axis=0, return_index=True)
    own = white[first] - white[first].mean(axis=0)
    error = np.abs(own.T @ own / n - np.eye(k)).max()
    assert abs(error - rows[0].identity_error) < 1e-6 and rows[0].identity_error < 1e-6


def test_whitening_equals_numpy(spark, random):
    vectors = random.normal(size=(150, 12)) @ random.normal(size=(12, 12))
    vectors = np.vstack([vectors, vectors[:1].repeat(80, axis=0)])
    check(whiten(frame(spark, vectors), 5).collect(), vectors, 5)


def test_fewer_vectors_than_dimensions(spark, random):
    vectors = random.normal(size=(4, 9)) * 5
    check(whiten(frame(spark, vectors), 16).collect(), vectors, 3)


def test_equal_eigenvalues(spark):
    """A cross: all directions alike."""
    vectors = np.vstack([np.eye(4), -np.eye(4)])
    rows = whiten(frame(spark, vectors), 3).collect()
    assert all(len(r.whitened) == 3 and r.identity_error < 1e-6 for r in rows)
    np.testing.assert_allclose(rows[0].explained, [0.25] * 3)


def test_close_eigenvalues_keep_their_vectors():
    """Two eigenvalues a relative 2e-13 apart; the vectors are right to the last digits."""
    u = np.array([[3, 4], [-4, 3]], object)
    values = [10**12 * 25, (10**12 + 5) * 25]
    m = (u.T.dot(np.diag(np.array(values, object))).dot(u)).tolist()
    p = [1, -(m[0][0] + m[1][1]), m[0][0] * m[1][1] - m[0][1] * m[1][0]]
    (first, _), (second, _) = exact.largest_roots(p, 2, m[0][0] + m[1][1])
    np.testing.assert_allclose(np.abs(exact.null_vectors(m, first, 1)[0]), [0.8, 0.6], rtol=1e-15)
    np.testing.assert_allclose(np.abs(exact.null_vectors(m, second, 1)[0]), [0.6, 0.8], rtol=1e-15)


def test_odd_vectors(spark, random):
    good = random.normal(size=(20, 3))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan, 1, 2], [inf, 1, 2], [None, 1, 2], [1.0, 2.0], [1e300, 0, 0], [-inf, 0, 0]]
    rows = whiten(frame(spark, [*good, *odd]), 2).collect()
    check(rows, good, 2)
    assert whiten(frame(spark, [[1, 2, 3], [1, 2, 3]])).select("n", "whitened", "identity_error").collect() == [(1, [], None)] * 2
    assert whiten(frame(spark, odd[:5])).collect() == []
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_entries_stay_exact(spark, random):
    vectors = random.normal(size=(30, 3)) * 1e12
    for r in whiten(frame(spark, vectors), 3).collect():
        x = whole(vectors).astype(object)
        y = 30 * x[r.vec_id] - x.sum(axis=0)
        assert int(r.deviation) == int((y * y).sum()) and r.identity_error < 1e-6


def test_null_and_repeated_ids(spark, random):
    v = [[float(x) for x in row] for row in random.normal(size=(6, 2))]
    rows = spark.createDataFrame([(None, v[0]), (1, v[1]), (1, v[2]), (None, v[0])], "vec_id long, embedding array<double>")
    assert sorted(r.vec_id or 0 for r in whiten(rows, 1).collect()) == [0, 0, 1, 1]


@pytest.mark.parametrize("name", ["sf0.001"])
def test_query(spark, name):
    folder = f"/root/testdata/{name}"
    rows = op13_embedding_whitening(spark, folder)
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").count()
    assert rows.count() == 16 * vectors
    assert sorted(r.component for r in rows.select("component").distinct().collect()) == list(range(1, 17))
    assert rows.selectExpr("max(identity_error) AS e").head().e < 1e-4
