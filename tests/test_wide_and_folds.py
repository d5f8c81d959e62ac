"""Correlations of wide tables against pandas, and folds cut within a group against cutting them one by one."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import analysis, forecast


@pytest.mark.parametrize("parts", [1, 6])
def test_wide_correlations(spark, parts):
    r, n, p = np.random.default_rng(1), 400, 30
    x = r.normal(size=(n, 5)) @ r.normal(size=(5, p)) + r.normal(size=(n, p)) * 0.3 + 1e6
    x[r.random((n, p)) < 0.2] = np.nan
    x[:, 3], x[:, 4], x[:, 5], x[1:, 6] = 7.0, x[:, 7] * 2, np.nan, np.nan
    names = [f"c{i:02d}" for i in range(p)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(row)) for row in x], ", ".join(f"{c} double" for c in names)).repartition(parts)
    want = pd.DataFrame(x, columns=names).corr(min_periods=2)
    got = analysis.wide_corr_matrix(df, cols=names).collect()
    assert len(got) == p * (p - 1) // 2
    for a, b, c in got:
        assert a < b and (c is None if np.isnan(want.loc[a, b]) else c == pytest.approx(want.loc[a, b], abs=1e-9))
    pairs = analysis.redundant_pairs(df, cols=names, least=0.9).collect()
    assert pairs[0][:2] == ("c04", "c07") and [abs(x.corr) for x in pairs] == sorted((abs(x.corr) for x in pairs), reverse=True)
    assert all(x.corr is None for x in analysis.wide_corr_matrix(df.limit(0), cols=names).collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_folds_of_a_series_are_cut_in_one_group(spark, parts):
    r, rows, cols = np.random.default_rng(2), [], ["x", "y"]
    for s, n in (("a", 120), ("b", 60), ("c", 3)):
        rows += [(s, i, float(r.normal()), None if r.random() < 0.1 else float(r.normal()), None if i + 1 >= n else float(r.normal()), None if i + 3 >= n else float(r.normal())) for i in range(n)]
    features = spark.createDataFrame(rows, "series string, row long, x double, y double, target_1 double, target_3 double").repartition(4)
    folds = [(s, c, h, 100.0, 101.0, max(0, c - h - 40), c - h) for s, c in (("a", 119), ("a", 100), ("a", 60), ("b", 59), ("b", 30), ("c", 2), ("d", 9)) for h in (1, 3, 7)]
    import datetime as dt

    bounds = spark.createDataFrame([(s, c, dt.date(2020, 1, 1) + dt.timedelta(days=c), h, p, a, lo, hi) for s, c, h, p, a, lo, hi in folds], "series string, cutoff_row long, cutoff_date date, step int, current_price double, actual_price double, train_start long, train_end long")
    got = {(x.series, x.cutoff_date, x.step): x for x in forecast.ridge_forecasts(features, bounds, keys=["series"], cols=cols, parts=parts).collect()}
    want = 0
    for s, c, h, price, _, lo, hi in folds:
        if h == 7 or s == "d":
            continue
        own = [x for x in rows if x[0] == s]
        train = [x for x in own if lo <= x[1] <= hi and x[4 if h == 1 else 5] is not None]
        row = got[s, dt.date(2020, 1, 1) + dt.timedelta(days=c), h]
        assert row.train_rows == len(train)
        if len(train) > 2:
            a = np.array([[np.nan if v is None else v for v in x[2:4]] for x in train])
            m = forecast.ridge_fit(a, np.array([x[4 if h == 1 else 5] for x in train]), 20.0)
            at = np.array([[np.nan if v is None else v for v in next(x for x in own if x[1] == c)[2:4]]])
            assert row.predicted == pytest.approx(price * np.exp(forecast.ridge_predict(m, at)[0]), rel=1e-9)
        else:
            assert row.predicted is None
        want += 1
    assert len(got) == want


def test_ridge_scales_are_numpys():
    """Gaps, ties, columns without values and few rows: medians and quartile ranges from one sort, as numpy's own."""
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 4, 9, 50, 51):
        x = np.round(r.normal(0, 3, (n, 5)), 1)
        center, scale = forecast._middle(x)
        assert np.array_equal(center, np.median(x, axis=0)) and np.allclose(scale, np.subtract(*np.percentile(x, [75, 25], axis=0)), rtol=0, atol=1e-12)
        x[r.random(x.shape) < 0.4], x[:, 4] = np.nan, np.nan
        med = forecast.ridge_fit(x, r.normal(size=n), 20.0)[0]
        assert med[4] == 0 and all(m == (np.nanmedian(c) if np.isfinite(c).any() else 0) for m, c in zip(med, x.T, strict=True))


def test_many_ridges_make_the_bars_once(spark):
    """Features and origins of all suppliers read bars that were aggregated once."""
    from tidemark.plans import forecast as plans

    plan = plans.ridge_forecasts_many(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" not in plan
