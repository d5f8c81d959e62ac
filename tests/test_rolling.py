"""Rolling statistics against Spark's own bounded frames, with batches shorter than the windows, and plans without such frames."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.rolling import rolling
from tidemark.operators import indicators, projections

SPANS = (1, 2, 5, 21, 63)


@pytest.fixture(scope="module")
def frame(spark):
    r, rows = np.random.default_rng(4), []
    for k, n in {"a": 150, "b": 40, "c": 1, None: 70}.items():
        for t in range(n):
            x = float(r.uniform(1, 9)) if t % 50 < 44 else 7.3
            odd = {20: math.nan, 90: math.inf, 91: None, 92: None}
            rows.append((k, t, odd[t] if k == "a" and t in odd else None if r.random() < 0.1 else x))
    return spark.createDataFrame(rows, "k string, t int, x double").repartition(3)


@pytest.mark.parametrize("whole", [False, True])
def test_equal_to_spark_frames(spark, frame, whole):
    out = {f"{kind}_{n}": (kind, "x", n) for kind in ("mean", "sd", "min", "max") for n in SPANS}
    own = {"mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max}
    over = lambda n: Window.partitionBy("k").orderBy("t").rowsBetween(-(n - 1), 0)
    want = frame.select("k", "t", *((F.when(F.count("x").over(over(n)) == n, own[kind]("x").over(over(n))) if whole else own[kind]("x").over(over(n))).alias(o) for o, (kind, _, n) in out.items()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = rolling(frame, keys=["k"], time="t", steps=[out], whole=whole).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(r.k, r.t): r for r in want.collect()}
    assert len(got) == len(want)
    for r in got:
        for o in out:
            a, b = r[o], want[r.k, r.t][o]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-12, abs=1e-12, nan_ok=True)), (r.k, r.t, o, a, b)


def test_a_constant_has_no_deviation(spark):
    df = spark.range(300).select(F.col("id").alias("t"), F.lit(0.1).alias("x"))
    assert {r.s for r in rolling(df, keys=[], time="t", steps=[{"s": ("sd", "x", 252)}]).collect()} == {None, 0.0}


@pytest.mark.parametrize("op", [projections.rolling_return_stats, projections.volume_zscore, indicators.sma_features, indicators.sliding_windows, indicators.ema_features])
def test_no_frame_is_gone_over_for_each_row(spark, op):
    df = spark.range(1).select(F.lit("a").alias("k"), F.col("id").alias("t"), *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")))
    plan = op(df, keys=["k"], time="t")._jdf.queryExecution().toString()
    assert "RowFrame, -19" not in plan and "RowFrame, -20" not in plan and "RowFrame, -62" not in plan and "RowFrame, -251" not in plan


def test_zscore_equals_spark_frames_without_them(spark, frame):
    """Gaps, constants, NaN and infinity; frames of 20 and 60 rows gone over for each row took most of ``zscore_long`` on 216 million lines."""
    got = indicators.zscore(frame, keys=["k"], time="t", col="x")
    plan = got._jdf.queryExecution().toString()
    assert "RowFrame, -19" not in plan and "RowFrame, -59" not in plan and got.columns == [*frame.columns, "zscore_20", "zscore_60"]
    over = lambda n: Window.partitionBy("k").orderBy("t").rowsBetween(-(n - 1), 0)
    sd = lambda n: F.stddev_samp("x").over(over(n))
    want = {(r.k, r.t): r for r in frame.withColumns({f"zscore_{n}": F.when(sd(n) > 0, (F.col("x") - F.avg("x").over(over(n))) / sd(n)) for n in (20, 60)}).collect()}
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        for o in ("zscore_20", "zscore_60"):
            a, b = r[o], want[r.k, r.t][o]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9, nan_ok=True)), (r.k, r.t, o, a, b)
