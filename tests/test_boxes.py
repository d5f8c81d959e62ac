"""Sums over earlier points in a box against comparing all pairs."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import analogs, boxes


@pytest.mark.parametrize("n", [1, 2, 5, 64, 777, 1_500])
def test_trees_and_prefixes(n):
    r = np.random.default_rng(n)
    x, y, v = np.round(r.normal(size=n), 1), np.round(r.normal(size=n), 1), r.normal(size=(n, 3))
    q, upto = r.normal(size=(80, 2)), r.integers(0, n + 1, 80)
    box = np.column_stack([q[:, 0] - 0.5, q[:, 0] + 0.5, q[:, 1] - 0.3, q[:, 1] + 0.3])
    inside = lambda b, u: (x[:u] >= b[0]) & (x[:u] <= b[1]) & (y[:u] >= b[2]) & (y[:u] <= b[3])
    assert np.allclose(boxes.tree_sums(x, y, v, box), [v[inside(b, n)].sum(0) for b in box], atol=1e-12)
    assert np.allclose(boxes.prefix_sums(x, y, v, box, upto), [v[:u][inside(b, u)].sum(0) for b, u in zip(box, upto, strict=True)], atol=1e-12)


def test_work_is_not_quadratic():
    """65,536 queries of a box that holds a quarter of all 65,536 points: a billion pairs, in a few seconds."""
    import time

    r = np.random.default_rng(1)
    x, y, v = r.random(1 << 16), r.random(1 << 16), np.ones((1 << 16, 1))
    began = time.time()
    out = boxes.tree_sums(x, y, v, np.column_stack([x - 0.25, x + 0.25, y - 0.25, y + 0.25]))
    assert time.time() - began < 60 and out.sum() > 1e8


@pytest.mark.parametrize("block", [300, 1 << 16])
def test_regime_over_blocks(spark, block):
    """Two series over several blocks, missing prices, a null key and times off the end of February."""
    r, rows = np.random.default_rng(2), []
    for k, n in (("a", 1_100), (None, 700), ("b", 5)):
        price = 100.0
        for i in range(n):
            price *= 1 + r.normal() * 0.02
            rows.append((k, dt.date(2015, 1, 1) + dt.timedelta(days=i), None if r.random() < 0.03 else float(price)))
    df = analogs.future_returns(spark.createDataFrame(rows, "series string, date date, close double").repartition(4), keys=["series"], time="date")
    out = analogs.regime(df, keys=["series"], time="date", block=block)
    got = {(x.series, x.date): x for x in out.collect()}
    assert len(got) == len(rows)
    base = out.select("series", "date", "ret_21", "vol_21", *(f"future_{h}" for h in (5, 7, 10, 21))).withColumn("until", F.add_months("date", -12)).toPandas()
    for k in ("a", None, "b"):
        s = base[base["series"].isna() if k is None else base["series"] == k].sort_values("date").reset_index(drop=True)
        x, v, day = s["ret_21"].to_numpy(float), s["vol_21"].to_numpy(float), s["date"].to_numpy()
        for i in range(0, len(s), 7):
            match = (np.abs(x - x[i]) <= 2.0) & (np.abs(v - v[i]) <= 0.35) & (day <= s["until"][i])
            row = got[k, s["date"][i]]
            for h, mean, up in ((5, row.regime_mean_5, row.regime_up_5), (7, row.regime_mean_7, row.regime_up_7), (21, row.regime_mean_21, row.regime_up_21)):
                f = s[f"future_{h}"].to_numpy(float)[match]
                f = f[~np.isnan(f)]
                assert row[f"regime_n_{h}"] == len(f)
                assert (mean, up) == ((None, None) if not len(f) else (pytest.approx(f.mean(), rel=1e-9), pytest.approx((f > 0).mean(), rel=1e-9)))
    assert sum(x.regime_n_5 for x in got.values()) > 10_000


def test_empty(spark):
    df = analogs.future_returns(spark.createDataFrame([], "series string, date date, close double"), keys=["series"], time="date")
    assert analogs.regime(df, keys=["series"], time="date").count() == 0
