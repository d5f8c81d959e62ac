"""Chunked windows and carried state against the operators on whole series and against pandas, on odd series and on one of a million rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import chunks
from tidemark.functions.windows import exponential
from tidemark.operators import indicators, joins, long_series, projections

SCHEMA = "k string, t long, open double, high double, low double, close double, volume double"


def bars(seed: int, sizes: dict) -> list[tuple]:
    r, rows = np.random.default_rng(seed), []
    for k, n in sizes.items():
        for t in sorted(r.choice(10 * n + 1, n, replace=False).tolist()):
            p = sorted(r.uniform(50, 150, 4).tolist())
            v = [p[1], p[3], p[0], p[2], float(r.integers(0, 99))]
            rows.append((k, t, *(None if r.random() < 0.15 else x for x in v)))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    """A series far longer than a chunk, some as long as a chunk and its halo, one row alone, and a null key."""
    return spark.createDataFrame(bars(1, {"long": 700, "mid": 90, "exact": 60, "one": 1, None: 75}), SCHEMA).repartition(5)


def rows_of(df) -> list[str]:
    cell = lambda x: None if x is None else "nan" if x != x else round(x, 7) + 0.0 if isinstance(x, float) else x
    return sorted(repr([cell(r[c]) for c in sorted(df.columns)]) for r in df.collect())


SMALL = {
    "sma_features": ({"spans": [3, 20]}, 19), "ema_features": ({"spans": [3, 8]}, 8), "bollinger": ({}, None), "rsi": ({}, None), "macd": ({"fast": 3, "slow": 7, "signal": 4}, 10), "roc": ({}, None), "stochastic": ({}, None), "adx": ({}, None),
    "zscore": ({"spans": (4, 20)}, 19), "sliding_windows": ({"spans": (5, 21)}, 21), "ewma_features": ({"spans": (5, 21)}, 21), "bar_shape": ({}, None), "log_bar_features": ({}, None), "log_return_lags": ({"lags": (1, 9)}, 10), "rolling_return_stats": ({"spans": (5, 21)}, 22), "volume_zscore": ({"spans": (5, 21)}, 21),
}


@pytest.mark.parametrize("name", sorted(SMALL))
def test_windows_equal_those_on_whole_series(frame, name):
    spans, reach = SMALL[name]
    op = getattr(indicators, name, None) or getattr(projections, name)
    assert rows_of(long_series.windows(frame, name, keys=["k"], time="t", rows=60, reach=reach, **spans)) == rows_of(op(frame, keys=["k"], time="t", **spans))


def test_every_operator_with_a_reach_is_tried():
    assert set(SMALL) == set(long_series.REACH)


def test_cci_labels_and_fills(frame):
    by = {"keys": ["k"], "time": "t"}
    assert rows_of(long_series.cci(frame, **by, rows=30)) == rows_of(indicators.cci(frame, **by))
    assert rows_of(long_series.target_labels(frame, **by, rows=30)) == rows_of(projections.target_labels(frame, **by))
    assert rows_of(long_series.ffill_causal(frame, **by, cols=["open", "volume"], rows=30)) == rows_of(projections.ffill_causal(frame, **by, cols=["open", "volume"]))
    days = frame.withColumn("t", F.date_add(F.lit("2000-01-01").cast("date"), F.col("t").cast("int")))
    for gap in (0, 1, 5, 40):
        given = {**by, "cols": ["open", "low"], "max_gap_days": gap, "when": F.col("close").isNotNull()}
        assert rows_of(long_series.ffill_bounded(days, **given, rows=30)) == rows_of(joins.ffill_bounded(days, **given))
    with pytest.raises(ValueError, match="negative"):
        long_series.ffill_bounded(days, **by, cols=["open"], max_gap_days=-1)


@pytest.mark.parametrize("strict", [True, False])
def test_asof_with_ties_over_ranges(spark, frame, strict):
    """Right rows at the very times of left ones, and long stretches without any, so that values are carried over many ranges."""
    r = np.random.default_rng(2)
    right = [("long", int(t), float(i), None if i % 3 else "x") for i, t in enumerate(sorted(set(r.integers(0, 700, 30).tolist() + [x[1] for x in bars(1, {"long": 700})[:400:40]])))] + [("other", 5, 1.0, "y"), ("mid", 0, 2.0, None)]
    right = spark.createDataFrame(right, "k string, s long, x double, y string")
    given = {"keys": ["k"], "left_time": "t", "right_time": "s", "cols": ["x", "y"], "strict": strict}
    assert rows_of(long_series.asof(frame, right, **given, rows=20)) == rows_of(joins.asof(frame, right, **given))
    assert rows_of(long_series.asof(frame, right.limit(0), **given, rows=20)) == rows_of(joins.asof(frame, right.limit(0), **given))


def test_empty_and_unkeyed(spark, frame):
    assert long_series.windows(frame.limit(0), "rsi", keys=["k"], time="t").count() == 0
    assert long_series.ffill_causal(frame.limit(0), keys=["k"], time="t", cols=["open"]).count() == 0
    one = frame.where("k = 'long'")
    assert rows_of(long_series.windows(one, "roc", keys=[], time="t", rows=50)) == rows_of(indicators.roc(one, keys=[], time="t"))
    with pytest.raises(ValueError, match="chunk"):
        long_series.windows(frame, "sma_features", keys=["k"], time="t", rows=60)
    with pytest.raises(ValueError, match="reach"):
        long_series.windows(frame, "zscore", keys=["k"], time="t", spans=(3,))


def test_exponential_averages_of_faulty_values(spark):
    values = [1.0, None, 3.0, math.nan, 5.0, math.inf, None, None, None, None, 11.0, 1e15, 13.0, 1.0, 1.0, 1.0, 1.0, 1.0]
    rows = [r.e for r in exponential(spark.createDataFrame(list(enumerate(values)), "t int, x double"), keys=[], time="t", averages={"e": ("x", 3)}).orderBy("t").collect()]
    for i, got in enumerate(rows):
        last = [(0.5**k, values[i - k]) for k in range(min(3, i + 1)) if values[i - k] is not None]
        if not last:
            assert got is None
        elif any(not math.isfinite(x) for _, x in last):
            assert math.isnan(got)
        else:
            assert got == pytest.approx(sum(w * x for w, x in last) / sum(w for w, _ in last), rel=1e-12)


def test_one_series_of_a_million_rows(spark, monkeypatch):
    """No group that a window sees is longer than a chunk and its halo; results equal pandas' on the whole series."""
    n, rows = 1_000_000, 50_000
    df = spark.range(0, n, 1, 8).select((F.col("id") * 7919 % n).alias("t")).withColumn("close", F.when(F.col("t") % 10 != 3, 100 + 10 * F.sin(F.col("t") / 50) + F.pmod(F.xxhash64("t"), 1000) / 100))
    largest = []

    def watched(part, *, keys, time):
        largest.append(part.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return indicators.ema_features(indicators.sma_features(part, keys=keys, time=time, spans=[200]), keys=keys, time=time, spans=[10, 200])

    out = chunks.in_chunks(df, watched, keys=[], time="t", before=399, rows=rows).toPandas().sort_values("t")
    assert largest[0] <= rows + 399 and len(out) == n and (out["t"].to_numpy() == np.arange(n)).all()
    x = out["close"].astype(float)
    assert np.nanmax(np.abs(out["sma_200"] - x.rolling(200, min_periods=1).mean())) < 1e-8
    for span in (10, 200):
        keep = 1 - 2 / (span + 1)
        weights = keep ** np.arange(span)
        top, low = np.convolve(x.fillna(0), weights)[:n], np.convolve(x.notna().astype(float), weights)[:n]
        assert np.nanmax(np.abs(out[f"ema_{span}"].astype(float).to_numpy() - np.divide(top, low, out=np.full(n, np.nan), where=low > 0))) < 1e-9
    filled = long_series.ffill_causal(df, keys=[], time="t", cols=["close"], rows=rows).toPandas().sort_values("t")["close"].astype(float).to_numpy()
    assert np.array_equal(filled, pd.Series(x.to_numpy()).ffill().to_numpy(), equal_nan=True)


def test_tasks_grow_with_rows_and_not_with_chunks(spark):
    """Short chunks of a long series: the number of ranges, which the driver hears of, is bounded by what a task may sort; small tables still have a range for each chunk."""
    assert chunks.parts_of(216_000_000, 4_000) == 432 and chunks.parts_of(36_000_000, 4_000) == 72 and chunks.parts_of(600, 60) == 10 and chunks.parts_of(0, 60) == 1
    parts, n = chunks.ranged(spark.range(20_000), keys=[], time="id", rows=20)
    assert n <= 2 * chunks.FEW_RANGES and parts.select("_range").distinct().count() <= n


@pytest.mark.parametrize("what", ["asof", "interval", "fill", "windows"])
def test_queries_run_few_tasks_however_short_chunks_are(spark, what):
    """Each task sends the driver some 9 KB of its figures: 1,000 chunks aren't 1,000 tasks of each stage."""
    df, by = spark.range(20_000).select("id", (F.col("id") % 97).cast("double").alias("close")), {"keys": [], "time": "id", "rows": 20}
    right, sides = df.where("id % 50 = 0").select(F.col("id").alias("s"), F.col("close").alias("x")), {"keys": [], "cols": ["x"], "rows": 20}
    group = f"few-tasks-{what}"
    spark.sparkContext.setJobGroup(group, group)
    if what == "asof":
        out = long_series.asof(df, right, left_time="id", right_time="s", **sides)
    elif what == "interval":
        out = long_series.interval_join(df, right, time="id", start="s", **sides)
    else:
        out = long_series.ffill_causal(df, **by, cols=["close"]) if what == "fill" else long_series.windows(df, "zscore", **by, reach=19, spans=(4, 20))
    assert out.count() == 20_000
    heard = spark.sparkContext.statusTracker()
    stages = {s for j in heard.getJobIdsForGroup(group) for s in heard.getJobInfo(j).stageIds}
    tasks = sum(heard.getStageInfo(s).numTasks for s in stages if heard.getStageInfo(s))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < tasks < 10 * chunks.FEW_RANGES
