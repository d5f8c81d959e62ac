"""Whitening against exact determinants, numpy's eigenvectors and definitions, on odd rows and repeated roots."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES


def determinant(a: list[list[Fraction]]) -> Fraction:
    a, out = [[Fraction(v) for v in row] for row in a], Fraction(1)
    for k in range(len(a)):
        i = next((i for i in range(k, len(a)) if a[i][k]), None)
        if i is None:
            return Fraction(0)
        if i != k:
            a[k], a[i], out = a[i], a[k], -out
        out *= a[k][k]
        for j in range(k + 1, len(a)):
            f = a[j][k] / a[k][k]
            a[j] = [x - f * y for x, y in zip(a[j], a[k], strict=True)]
    return out


def gram(rng, d: int, rows: int, most: int) -> np.ndarray:
    y = rng.integers(-most, most + 1, (rows, d)).astype(object)
    return y.T @ y


@pytest.mark.parametrize("d,rows,most", [(1, 3, 9), (2, 5, 100), (5, 2, 7), (7, 30, 10**9), (6, 4, 1)])
def test_polynomial_is_the_determinant(spark, d, rows, most):
    g = gram(np.random.default_rng(d), d, rows, most)
    c = whitening.polynomial(spark, g)
    assert len(c) == d + 1 and c[d] == 1
    for t in range(-2, d + 2):
        assert sum(x * t**k for k, x in enumerate(c)) == determinant([[t * (i == j) - int(g[i, j]) for j in range(d)] for i in range(d)])


def test_polynomial_of_sparse_and_zero_pivots():
    p = 2**31 - 1
    for g in ([[0, 0, 1], [0, 2, 0], [1, 0, 0]], [[0] * 4 for _ in range(4)], [[0, 1, 0, 0], [1, 0, 0, 0], [0, 0, 0, 1], [0, 0, 1, 0]]):
        c = whitening.polynomial_mod(g, p)
        for t in range(5):
            assert sum(x * t**k for k, x in enumerate(c)) % p == determinant([[t * (i == j) - g[i][j] for j in range(len(g))] for i in range(len(g))]) % p


def from_roots(roots: list[int]) -> list[int]:
    c = [1]
    for r in roots:
        c = [(c[k - 1] if k else 0) - r * (c[k] if k < len(c) else 0) for k in range(len(c) + 1)]
    return c


@pytest.mark.parametrize("roots", [[5], [0, 0, 3], [7, 7, 7, 2, 0], [10**12, 10**12 + 1, 10**12 + 2, 1, 1], [4, 3, 2, 1], [10**30, 1]])
def test_roots_with_multiplicity(roots):
    got, s = whitening.largest_roots(from_roots(roots), 16)
    want = sorted((r for r in roots if r), reverse=True)
    assert len(got) == len(want) and all(abs(Fraction(g, 1 << s) - w) <= Fraction(1, 1 << s) for g, w in zip(got, want, strict=True))
    assert [g == got[0] for g in got] == [w == want[0] for w in want]


def test_close_and_repeated_roots():
    """Eigenvalues of which some are equal and some differ in the 15th digit."""
    rng = np.random.default_rng(3)
    v = np.array([int(x) for x in rng.integers(-9, 10, 6)], object)
    block = np.eye(6, dtype=int).astype(object) * 10**15
    g = block + np.outer(v, v)  # 10^15 five times, and a little more once
    c = from_roots([10**15] * 5 + [10**15 + int(v @ v)])
    roots, s = whitening.largest_roots(c, 6)
    assert roots[0] != roots[1] and len(set(roots[1:])) == 1
    u = whitening.components(g, roots, s)
    assert np.abs(u @ u.T - np.eye(6)).max() < 1e-14
    assert abs(abs(u[0] @ v.astype(float)) / math.sqrt(float(v @ v)) - 1) < 1e-14


def check(rows: list, got: list, most: int = 16) -> None:
    """The definitions, with exact sums and numpy's eigenvectors."""
    kept = [(k, [math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fitted = sorted({tuple(x) for _, x in kept})
    n, d = len(fitted), len(fitted[0])
    s = [sum(x[i] for x in fitted) for i in range(d)]
    y = np.array([[float(Fraction(n * x[i] - s[i], n)) for i in range(d)] for x in fitted])
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1].T
    k = min(most, int((e > 1e-9 * e[0]).sum()))
    assert len(got) == len(kept) * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
        assert r.n == n and abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-6
    sign = {}
    for key, x in kept:
        away = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s, strict=True)])
        for c in range(1, k + 1):
            for r in by[key][c]:
                assert r.deviation == sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
            want = away @ v[c - 1] / math.sqrt(e[c - 1])
            value = by[key][c][0].whitened
            if abs(want) > 0.1:
                assert sign.setdefault(c, np.sign(want * value)) == np.sign(want * value)
            assert abs(abs(want) - abs(value)) < 1e-7


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    check(rows, QUERIES["op12_embedding_whitening"](spark, "/root/testdata/sf0.01").collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(k, [float(np.float32(c)) for c in rng.normal(size=5)]) for k in range(30)]
    rows = [*good, (3, good[3][1]), *((90 + k, good[0][1]) for k in range(40)), (50, None), (51, [1.0, None, 2.0, 3.0, 4.0]), (52, [math.nan] * 5), (53, [math.inf, 1.0, 1.0, 1.0, 1.0]), (54, [0.5, 0.5, 0.5, 0.5, 0.5])]
    df = spark.createDataFrame([(*r, 1) for r in [*rows, (60, [1.0, 2.0]), (61, [])]], "vec_id long, embedding array<float>, n int").repartition(4)
    check(rows, whitening.whiten(df).collect())
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(flat).count() == 0 and whitening.whiten(df.limit(0)).count() == 0
    two = whitening.whiten(flat.unionByName(spark.createDataFrame([(2, [3.0, 2.0])], "vec_id long, embedding array<float>")))
    assert {(r.vec_id, r.component, r.n, abs(r.whitened)) for r in two.collect()} == {(1, 1, 2, 1.0), (None, 1, 2, 1.0), (2, 1, 2, 1.0)}


def test_too_large_entries(spark):
    df = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(df).collect()


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for most in (100, 1 << 30, 1 << 45):
        y = rng.integers(-most, most, (50, 4))
        assert (whitening.products(y) == y.astype(object).T @ y.astype(object)).all()
