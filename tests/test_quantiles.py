"""Exact quantiles and rank correlations of large groups against numpy and plain windows."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.functions import chunks
from tidemark.operators import quantiles

SHARES = [0.0, 0.01, 0.25, 0.5, 0.513, 0.99, 1.0]
NAMES = [f"q{i}" for i in range(len(SHARES))]


def groups(seed: int) -> dict:
    r = np.random.default_rng(seed)
    return {
        "normal": r.normal(size=3_000), "ties": r.integers(0, 4, 3_000).astype(float), "half zero": np.where(r.random(2_500) < 0.5, 0.0, r.normal(size=2_500)), "huge": 10.0 ** r.uniform(-300, 300, 1_500) * r.choice([-1, 1], 1_500),
        "one value": np.full(1_200, 7.0), "small": r.normal(size=40), "one": np.array([3.0]), "two": np.array([1.0, 2.0]), None: r.normal(size=1_100),
    }


@pytest.mark.parametrize("seed,few", [(0, 100), (1, 7), (2, 100_000)])
def test_quantiles(spark, seed, few, monkeypatch):
    """Small limits, so that groups are selected in ranges, and ranges of many values are dealt out once more."""
    monkeypatch.setattr(quantiles, "RANGES", 16)
    own = groups(seed)
    rows = [(k, float(x)) for k, v in own.items() for x in v] + [("normal", None), ("nothing", None)] * 3
    df = spark.createDataFrame(rows, "k string, x double").repartition(6)
    got = {r.k: [r[n] for n in NAMES] for r in quantiles.quantiles(df, by=["k"], value="x", shares=SHARES, out=NAMES, large=1_000, few=few).collect()}
    assert got.pop("nothing") == [None] * len(SHARES)
    assert set(got) == set(own)
    for k, v in own.items():
        assert got[k] == pytest.approx(np.quantile(v, SHARES).tolist(), rel=1e-12)


def test_a_sketch_that_is_wrong(spark, monkeypatch):
    """Ranks outside of their ranges are found all the same."""
    monkeypatch.setattr(quantiles, "ACCURACY", 2)
    x = np.random.default_rng(3).normal(size=4_000)
    df = spark.createDataFrame([("a", float(v)) for v in x], "k string, x double").repartition(4)
    got = quantiles.quantiles(df, by=["k"], value="x", shares=SHARES, out=NAMES, large=100, few=50).first()
    assert [got[n] for n in NAMES] == pytest.approx(np.quantile(x, SHARES).tolist(), rel=1e-12)


def test_no_group_is_in_one_task(spark, monkeypatch):
    """Of a group of 200,000 values no window and no percentile sees more than a few."""
    seen = []
    plain = quantiles.Window.partitionBy
    df = spark.range(0, 200_000, 1, 8).selectExpr("'a' as k", "cast(pmod(xxhash64(id), 1000003) as double) as x")
    counts = quantiles.running_counts
    monkeypatch.setattr(quantiles, "running_counts", lambda d, **k: seen.append(d.count()) or counts(d, **k))
    got = quantiles.quantiles(df, by=["k"], value="x", shares=[0.5], out=["m"], large=1_000, few=5_000).first().m
    assert got == np.quantile([r.x for r in df.select("x").collect()], 0.5) and not seen and plain is quantiles.Window.partitionBy
    got = quantiles.quantiles(df, by=["k"], value="x", shares=[0.5], out=["m"], large=1_000, few=500).first().m
    assert got == np.quantile([r.x for r in df.select("x").collect()], 0.5) and max(seen) < 2 * 200_000 * 4 / quantiles.RANGES  # two ranks


def test_empty(spark):
    df = spark.createDataFrame([], "k string, x double, y double")
    assert quantiles.quantiles(df, by=["k"], value="x", shares=[0.5], out=["m"]).count() == 0
    assert quantiles.spearman(df, by=["k"], a="x", b="y").count() == 0


def ranks(x: np.ndarray) -> np.ndarray:
    return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])


@pytest.mark.parametrize("rows", [20, 100_000])
def test_spearman(spark, rows):
    """By ranges and by windows; one value of one side is in a third of the rows."""
    r, own = np.random.default_rng(4), {}
    for k, n in (("a", 400), (None, 150), ("b", 2)):
        x = r.integers(0, 60, n).astype(float)
        own[k] = (np.where(r.random(n) < 0.35, 5.0, x), x + r.normal(size=n) * 20)
    own["flat"] = (np.ones(30), r.normal(size=30))
    data = [(k, float(a), float(b)) for k, (x, y) in own.items() for a, b in zip(x, y, strict=True)] + [("a", None, 1.0), ("a", 1.0, None)]
    df = spark.createDataFrame(data, "k string, x double, y double").repartition(5)
    got = {r.k: (r.rho, r.n) for r in quantiles.spearman(df, by=["k"], a="x", b="y", rows=rows).collect()}
    assert set(got) == set(own) and got["flat"] == (None, 30)
    for k in ("a", None, "b"):
        x, y = own[k]
        assert got[k][1] == len(x) and got[k][0] == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1], rel=1e-12)


def test_average_ranks_pass_ranges_on(spark):
    values = [1.0] * 5 + [2.0] + [3.0] * 7 + [4.0, 5.0, 6.0]
    counts = spark.createDataFrame([("g", x) for x in values], "k string, x double").groupBy("k", "x").count()
    got = {r.x: r["rank"] for r in quantiles.average_ranks(counts, by=["k"], value="x", count="count", rows=2).collect()}
    assert got == {1.0: 3.0, 2.0: 6.0, 3.0: 10.0, 4.0: 14.0, 5.0: 15.0, 6.0: 16.0} and chunks.CHUNK_ROWS > 2
