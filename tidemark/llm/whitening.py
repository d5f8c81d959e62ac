"""Whitening of embeddings through an exact characteristic polynomial.

Entries become integers, ``x = floor(64 c) + 1000000``, and every distinct vector is fitted once. Sums, and products of centred vectors, are exact
integers, so that ``G = n sum(y y') - T T'`` (y: x less the rounded mean, T: their sum) is the covariance times n^2 without any rounding. Its characteristic polynomial is found modulo
many primes, each by a reduction to Hessenberg form in a task of its own, and put together by Chinese remainders; the number of primes follows from a bound on the
coefficients. All roots are real, so the number of roots above t is the number of sign changes in the coefficients shifted by t (Descartes): halving
isolates the largest roots, and signs alone then give each to hundreds of bits. Components span the null space of ``G - root``: inverse iteration on a
fixed-point elimination of as many bits, kept orthogonal among roots that agree to the last bit, so close roots cost no precision.

What reaches the driver is one d x d matrix, sums, and d + 1 remainders for each prime.

Nulls and edge cases: rows whose vector is null or has an entry that is null or isn't finite give nothing; nor do rows of another length than most rows have (on a tie the
longer). Repeated rows are all given and fitted once; a null ``vec_id`` stays. Directions without any spread (a root of 0) aren't components, so a table of
equal vectors, or an empty one, gives an empty result. Entries beyond 2^40 raise an error. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts, written

SCALE, SHIFT, MOST_ENTRY = 64, 1_000_000, 1 << 40
#: Bits after the point, relative to the largest root, to which roots are found and vectors are computed.
ROOT_BITS, FIXED_BITS = 200, 320


def integers(rows: DataFrame, *, key: str, vector: str) -> DataFrame:
    """(key, x) of the rows that have a vector of finite entries."""
    v = F.col("v")
    rows = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).where(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    entry = lambda c: F.when(F.abs(c) * SCALE < MOST_ENTRY, F.floor(c * SCALE) + SHIFT).otherwise(F.raise_error(F.lit("an entry is too large to be whitened")).cast("long"))
    rows = rows.select("key", F.transform("v", entry).alias("x"))
    size = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    return rows.where(F.size("x") == (size["d"] if size else 0))


def _matrix(b: pa.RecordBatch, column: str = "x") -> np.ndarray:
    x = b.column(column)
    return np.asarray(x.flatten(), np.int64).reshape(len(x), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        if len(b.column(0)):
            x = _matrix(b)
            s = np.append(x.sum(0), len(x))
            total = s if total is None else total + s
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total, pa.int64())], ["i", "s"])


def sums_of(vectors: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and the sum of each dimension."""
    rows = vectors.select("x").mapInArrow(_sums, "i long, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # dimensions + 1 rows
    s = {r["i"]: int(r["s"]) for r in rows}
    return (s[len(s) - 1], [s[i] for i in range(len(s) - 1)]) if s else (0, [])


def products(y: np.ndarray) -> np.ndarray:
    """y' y as exact integers: in floating point where all sums are below 2^53, else in parts of few bits."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        return (y.T.astype(np.float64) @ y.astype(np.float64)).astype(np.int64).astype(object)
    high = y >> 20
    low = y - (high << 20)
    if max(int(np.abs(high).max()), 1 << 20) ** 2 * len(y) < 1 << 53:
        h, lo = high.astype(np.float64), low.astype(np.float64)
        exact = lambda a, b: (a.T @ b).astype(np.int64).astype(object)
        cross = exact(h, lo)
        return (exact(h, h) << 40) + ((cross + cross.T) << 20) + exact(lo, lo)
    return y.astype(object).T @ y.astype(object)


def scatter(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """``n^2`` times the covariance, in Python integers. Vectors are centred by the rounded mean before they are multiplied; what rounding left is taken off exactly."""
    middle = [(2 * s + n) // (2 * n) for s in sums]
    d = len(sums)
    centre, (rows, cols) = np.array(middle, np.int64), np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(rows), object)
        for b in batches:
            if len(b.column(0)):
                total = total + products(_matrix(b) - centre)[rows, cols]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array([str(t) for t in total])], ["i", "s"])

    parts_of = vectors.select("x").mapInArrow(run, "i long, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    g = np.zeros((d, d), object)
    for r in parts_of.collect():  # d (d + 1) / 2 rows
        g[rows[r["i"]], cols[r["i"]]] = g[cols[r["i"]], rows[r["i"]]] = n * int(r["s"])
    t = np.array([s - n * m for s, m in zip(sums, middle, strict=True)], object)
    return g - np.outer(t, t)


def _primes_below(top: int, count: int) -> list[int]:
    """The largest primes below ``top``."""
    small = [p for p in range(2, math.isqrt(top) + 1) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    found, end = [], top
    while len(found) < count:
        start = max(2, end - 200_000)
        alive = np.ones(end - start, bool)
        for p in small:
            first = -(-start // p) * p
            alive[max(first, p * p) - start :: p] = False
        found += [int(start + k) for k in np.flatnonzero(alive)[::-1]]
        end = start
    return found[:count]


def polynomial_mod(g: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - g) modulo the prime p (below 2^31), the constant first."""
    d = len(g)
    h = np.array([[v % p for v in row] for row in g], np.int64)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        i = k + 1 + int(below[0])
        if i != k + 1:
            h[[i, k + 1]] = h[[k + 1, i]]
            h[:, [i, k + 1]] = h[:, [k + 1, i]]
        f = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - f[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * f % p).sum(1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for m in range(1, d + 1):
        poly[m, 1 : m + 1] = poly[m - 1, :m]
        poly[m] = (poly[m] - h[m - 1, m - 1] * poly[m - 1] % p) % p
        under = 1
        for i in range(1, m):
            under = under * int(h[m - i, m - i - 1]) % p
            if not under:
                break
            poly[m] = (poly[m] - int(h[m - i - 1, m - 1]) * under % p * poly[m - i - 1] % p) % p
    return poly[d].tolist()


def polynomial(spark: SparkSession, g: np.ndarray) -> list[int]:
    """The characteristic polynomial of an integer matrix without negative roots, the constant first: primes are dealt over the tasks."""
    d, rows = len(g), g.tolist()
    trace = max(1, sum(rows[i][i] for i in range(d)))
    # The k-th symmetric sum of roots that add up to the trace is largest where all are equal.
    bits = max(math.ceil(math.log2(math.comb(d, k)) + k * (math.log2(trace) - math.log2(d))) for k in range(d + 1)) + 2
    primes = _primes_below(1 << 31, bits // 30 + 1)
    sent = spark.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([primes[k]]), pa.array([polynomial_mod(sent.value, primes[k])], pa.list_(pa.int64()))], ["p", "c"])

    left = {r["p"]: r["c"] for r in spark.range(0, len(primes), 1, min(len(primes), 2 * parts(spark))).mapInArrow(run, "p long, c array<long>").collect()}
    whole = math.prod(primes)
    weight = [whole // p * pow(whole // p, -1, p) for p in primes]
    found = [sum(w * left[p][k] for w, p in zip(weight, primes, strict=True)) % whole for k in range(d + 1)]
    return [c - whole if 2 * c > whole else c for c in found]


def _above(c: list[int], t: int) -> int:
    """How many roots are above t, each as often as it counts. All roots are real: sign changes of the polynomial shifted by t."""
    c = c[:]
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += t * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(c: list[int], t: int) -> int:
    v = 0
    for x in reversed(c):
        v = v * t + x
    return (v > 0) - (v < 0)


def largest_roots(c: list[int], most: int) -> tuple[list[int], int]:
    """The ``most`` largest positive roots of a polynomial whose roots are all real, as integers in units of 2^-s, and s. Roots that agree to the last bit
    come as often as they count."""
    d = len(c) - 1
    bound = max(1, -c[d - 1])  # the sum of the roots, none of which is negative
    s = max(0, ROOT_BITS - bound.bit_length())
    c = [x << s * (d - k) for k, x in enumerate(c)]
    zeros = next(k for k, x in enumerate(c) if x)
    c, d = c[zeros:], d - zeros
    out, open_ = [], [(0, (bound << s) + 1, 0, d)]  # (low, high], roots above high, roots above low
    while open_ and len(out) < most:
        low, high, over, upto = open_.pop()
        if over == upto:
            continue
        if upto - over == 1:
            at_high = _sign(c, high)
            if not at_high:
                low = high - 1
            while high - low > 1:
                middle = (low + high) // 2
                sign = _sign(c, middle)
                low, high = (middle, high) if sign == -at_high else (low, middle)
        elif high - low > 1:
            middle = (low + high) // 2
            n = _above(c, middle)
            open_ += [(low, middle, n, upto), (middle, high, over, n)]
            continue
        out += [high] * (upto - over)
    return out[:most], s


def _solve(a: np.ndarray, bits: int):
    """Elimination with pivots of fixed-point numbers of ``bits`` bits; returns a function that solves for a right side."""
    a, d, order, steps = a.copy(), len(a), [], []
    for k in range(d):
        i = k + max(range(d - k), key=lambda j: abs(a[k + j, k]))
        order.append(i)
        if i != k:
            a[[k, i]] = a[[i, k]]
        if not a[k, k]:
            a[k, k] = 1  # the last bit: inverse iteration wants it near zero, not zero
        f = np.array([(v << bits) // a[k, k] for v in a[k + 1 :, k]], object)
        steps.append(f)
        if len(f):
            a[k + 1 :, k:] -= np.outer(f, a[k, k:]) >> bits

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for k in range(d):
            b[[k, order[k]]] = b[[order[k], k]]
            if k + 1 < d:
                b[k + 1 :] -= (steps[k] * b[k]) >> bits
        for k in range(d - 1, -1, -1):
            b[k] = ((b[k] - (int(a[k, k + 1 :] @ b[k + 1 :]) >> bits if k + 1 < d else 0)) << bits) // a[k, k]
        return b

    return solve


def _unit(v: np.ndarray, bits: int) -> np.ndarray:
    size = math.isqrt(int(v @ v))
    return np.array([(int(x) << bits) // size for x in v], object)


def components(g: np.ndarray, roots: list[int], s: int) -> np.ndarray:
    """Unit vectors of the null spaces of g - root, one for each root. Roots that agree share one elimination, and their vectors stay at right angles."""
    d, bits = len(g), FIXED_BITS
    scale = max(1, max(abs(int(v)) for v in g.ravel()).bit_length())
    fixed = np.array([[(int(v) << bits) >> scale for v in row] for row in g], object)
    rng, out, k = np.random.default_rng(1), [], 0
    while k < len(roots):
        same = roots.count(roots[k])
        a = fixed.copy()
        shift = (roots[k] << bits) >> scale + s
        for i in range(d):
            a[i, i] -= shift
        solve, group = _solve(a, bits), []
        for _ in range(same):
            v = _unit(np.array([int(x) for x in rng.integers(-(1 << 40), 1 << 40, d)], object), bits)
            for _turn in range(3):
                v = _unit(solve(v), bits)
                for u in group:
                    v = v - (u * (int(u @ v) >> bits) >> bits)
                v = _unit(v, bits)
            group.append(v)
        out += group
        k += same
    return np.array([[float(Fraction(int(x), 1 << bits)) for x in v] for v in out], np.float64).reshape(len(out), d)


class Whitener:
    """What :func:`fit` learns: n, the sums, the components and their eigenvalues, each one's part of the spread, and the error of the whitened covariance."""

    def __init__(self, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray, explained: np.ndarray):
        self.n, self.sums, self.vectors, self.values, self.explained, self.identity_error = n, sums, vectors, values, explained, 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; x - S/n is exact up to its last rounding."""
        away = self._away(x)
        return (away.astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def _away(self, x: np.ndarray) -> np.ndarray:
        if self.n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def deviation(self, x: np.ndarray) -> list[int]:
        away = self._away(x).astype(object)
        return (away * away).sum(1).tolist() if len(away) else []


def fit(vectors: DataFrame, most: int = 16) -> Whitener | None:
    """Fit on the distinct vectors ``x``; None where nothing spreads."""
    spark = vectors.sparkSession
    n, sums = sums_of(vectors)
    if not n or not sums:
        return None
    g = scatter(vectors, n, sums)
    trace = sum(int(g[i, i]) for i in range(len(g)))
    if not trace:
        return None
    roots, s = largest_roots(polynomial(spark, g), most)
    values = np.array([float(Fraction(r, n * n << s)) for r in roots])
    w = Whitener(n, sums, components(g, roots, s), values, np.array([float(Fraction(r, trace << s)) for r in roots]))
    w.identity_error = _identity_error(vectors, w)
    return w


def _identity_error(vectors: DataFrame, w: Whitener) -> float:
    """The largest difference between the whitened fit list's covariance and the identity. Sums are small and of like size, so their order doesn't matter."""
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            if len(b.column(0)):
                y = np.column_stack([w.project(_matrix(b)), np.ones(len(b.column(0)))])
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "s"])

    rows = vectors.select("x").mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()  # (components + 1)^2 rows
    total = np.zeros((k + 1) ** 2)
    for r in rows:
        total[r["i"]] = r["s"]
    total = total.reshape(k + 1, k + 1) / w.n
    mean = total[k, :k]
    return float(np.abs(total[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", most: int = 16) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for every row with a vector and component up to ``most``."""
    kind = rows.schema[key].dataType.simpleString()
    rows = integers(rows, key=key, vector=vector)
    w = fit(written(rows.select("x").distinct()), most)
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if w is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b.column(0)):
                continue
            x = _matrix(b)
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)), pa.array(np.repeat(np.array(w.deviation(x), object), k).tolist(), pa.int64()),
                pa.array(w.project(x).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, w.identity_error)),
            ], ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
