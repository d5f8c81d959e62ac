"""Ridge forecasts of many series whose folds travel on their rows: against those by a table of folds, and how often rows are shuffled."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.windows import ordered
from tidemark.operators import forecast, projections
from tidemark.plans import QUERIES
from tidemark.plans import forecast as plans

BY = {"keys": ["series"], "time": "date"}
COLS = plans.RIDGE_COLS


def _bars(spark):
    """Series of several lengths with gaps, prices that have no logarithm, volumes that don't vary, are negative or NaN."""
    r, rows = np.random.default_rng(4), []
    for s, n in ((1, 180), (2, 95), (3, 31), (4, 11), (5, 10), (6, 1)):
        for i in range(n):
            open_, close = (float(x) for x in np.exp(r.normal(3, 1, 2)))
            volume = 5.0 if s == 2 and 20 < i < 60 else float("nan") if r.random() < 0.01 else float(r.integers(-3, 40))
            close = None if r.random() < 0.03 else 0.0 if r.random() < 0.03 else close
            rows.append((s, dt.date(2020, 1, 1) + dt.timedelta(days=i), None if r.random() < 0.03 else open_, close, volume))
    return spark.createDataFrame(rows, "series long, date date, open double, close double, volume double").repartition(5)


@pytest.mark.parametrize(("windows", "train"), [(1, 1260), (2, 40)])
def test_folds_on_rows_give_the_same_forecasts(spark, windows, train):
    bars, short = _bars(spark), {"spans": (21,)}
    df = projections.volume_zscore(projections.rolling_return_stats(projections.log_bar_features(bars, **BY), **BY, **short), **BY, **short)
    df = forecast.direct_target(df, **BY, horizons=forecast.HORIZONS).withColumn("row", (F.row_number().over(ordered(["series"], "date")) - 1).cast("long"))
    bounds = forecast.training_bounds(forecast.rolling_origins(bars, **BY, windows=windows), train=train)
    want = forecast.ridge_forecasts(df, bounds, keys=["series"], cols=COLS)
    rows = forecast.direct_target(projections.log_bar_features(bars, **BY), **BY, horizons=forecast.HORIZONS)
    rows = rows.withColumns({"row": (F.row_number().over(ordered(["series"], "date")) - 1).cast("long"), "_x": F.col("close"), "_v": projections.log_volume()})
    rows = forecast.with_folds(rows, **BY, horizons=forecast.HORIZONS, windows=windows, train=train, before=20)
    got = forecast.ridge_forecasts_within(rows, **BY, cols=COLS, steps=projections.return_steps(21))
    assert got.columns == want.columns and got.dtypes == want.dtypes
    key = lambda x: (x.series, x.cutoff_date, x.step)
    got, want = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert len(got) == len(want) and {x.series for x in got} == {1, 2, 3, 4}
    for a, b in zip(got, want, strict=True):
        assert all(x == pytest.approx(y, rel=1e-9) if isinstance(x, float) and math.isfinite(x) else x == y or x != x and y != y for x, y in zip(a, b, strict=True)), (a, b)
    assert sum(x.predicted is not None and math.isfinite(x.predicted) for x in got) > len(got) / 2


def test_many_ridges_shuffle_only_lines(spark, monkeypatch):
    """What is shuffled and stored on the way would fill the disks of a large table: lines go to their series once, and windows, folds and fits stay there."""
    kept = []
    monkeypatch.setattr(plans, "stored_columns", lambda df: kept.append(df) or df)
    made = QUERIES["ridge_forecasts_many"](spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan
    assert [df.columns for df in kept] == [made.columns]  # bars aren't stored


def test_many_ridges_are_those_of_stored_bars(spark):
    sf = "/root/testdata/sf0.001"
    bars = plans.views.bars_many(spark, sf)
    bounds = forecast.training_bounds(forecast.rolling_origins(bars, **BY, windows=1))
    want = forecast.ridge_forecasts(plans.ridge_features(spark, sf, lambda *_: bars), bounds, keys=["series"], cols=COLS).collect()
    got = {(x.series, x.step): x for x in QUERIES["ridge_forecasts_many"](spark, sf).collect()}
    assert len(got) == len(want) > 0
    for x in want:
        y = got[x.series, x.step]
        assert (x.cutoff_date, x.train_rows, x.current_price, x.actual_price) == (y.cutoff_date, y.train_rows, y.current_price, y.actual_price) and y.predicted == pytest.approx(x.predicted, rel=1e-9)


def test_rows_without_a_key_are_a_series(spark):
    """As a group in SQL; a join with a table of folds would lose them."""
    bars = _bars(spark).where("series = 2")
    one, none = ({(x.cutoff_date, x.step): x.predicted for x in plans._ridge_many(b).collect()} for b in (bars, bars.withColumn("series", F.lit(None).cast("long"))))
    assert len(one) == len(forecast.HORIZONS) and none == one
