"""Small inline cases: causality, independence of series, guards and known values."""

from __future__ import annotations

import datetime as dt
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import analogs, analysis, forecast, indicators, joins, projections, quality
from tidemark.sources import landing

BY = {"keys": ["series"], "time": "date"}
DAY = dt.date(2020, 1, 1)


def bars(spark, n=300, series=("a",), last=None):
    rows = []
    for k, s in enumerate(series):
        for i in range(n):
            c = 1000.0 + i * (1 + k) + (i * 7919 % 13)
            if last is not None and i == n - 1:
                c = last
            rows.append((s, DAY + dt.timedelta(days=i), c - 2, c + 4, c - 5, c, 100.0 + i % 17))
    return spark.createDataFrame(rows, "series string, date date, open double, high double, low double, close double, volume double")


FEATURES = [
    indicators.sma_features, indicators.ema_features, indicators.bollinger, indicators.momentum_features, indicators.adx, indicators.zscore, indicators.sliding_windows, indicators.ewma_features,
    projections.bar_shape, projections.log_bar_features, projections.log_return_lags, projections.rolling_return_stats, projections.volume_zscore, projections.period_to_date,
]


@pytest.mark.parametrize("op", FEATURES, ids=lambda f: f.__name__)
def test_causality(spark, op):
    """Changing the last row leaves all rows before it as they were."""
    a, b = (op(bars(spark, 80, last=x), **BY).where(F.col("date") < DAY + dt.timedelta(days=79)).orderBy("date").collect() for x in (None, 5000.0))
    assert [tuple(x) for x in a] == [tuple(x) for x in b]


@pytest.mark.parametrize("op", FEATURES, ids=lambda f: f.__name__)
def test_series_do_not_mix(spark, op):
    both = bars(spark, 60, ("a", "b"))
    together = {tuple(x) for x in op(both, **BY).collect()}
    alone = {tuple(x) for s in "ab" for x in op(both.where(F.col("series") == s), **BY).collect()}
    assert together == alone


def test_training_bounds(spark):
    row = spark.createDataFrame([(2000, 10)], "cutoff_row long, step int")
    x = forecast.training_bounds(row).first()
    assert (x.train_end, x.train_rows) == (1990, 1260)


def test_targets_are_not_features(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, "x")], "close double, next_1_day_open double, cpi double, name string")
    assert projections.safe_features(df, blocked=[], unsafe=["cpi"]) == ["close"]


def test_next_sessions_skip_weekend_and_holiday(spark):
    last = spark.createDataFrame([("a", dt.date(2026, 6, 18))], "series string, date date")
    holidays = spark.createDataFrame([(dt.date(2026, 6, 19),)], "date date")
    got = [x.forecast_date for x in forecast.next_sessions(last, holidays, **BY, n=2).orderBy("step").collect()]
    assert got == [dt.date(2026, 6, 22), dt.date(2026, 6, 23)]


def test_intervals_of_constant_residual(spark):
    future = spark.createDataFrame([(h, 100.0 + h) for h in range(1, 11)], "step int, predicted double")
    past = spark.createDataFrame([(h, 10.0, 9.0) for h in range(1, 11) for _ in range(2)], "step int, actual_price double, predicted double")
    rows = forecast.prediction_intervals(future, past, by=["step"]).orderBy("step").collect()
    assert len(rows) == 10 and rows[0].lower_80 == 100.0 and rows[0].upper_95 == 102.0


def said(name: str, scale: float, sign: int, **more) -> forecast.Driver:
    return forecast.Driver(scale, sign, name, f"{name} rose {{}}.", f"{name} fell {{}}.", **more)


SPEC = {"real_yield": said("Real yield", 0.1, -1), "vix": said("Vix", 10.0, 1, zero_rose=False), "gone": said("Gone", 1.0, 1), "dollar": said("Dollar", 1.0, -1)}


def test_context(spark):
    pred = spark.createDataFrame([("a", 100.0, 102.0), ("b", 100.0, 100.01), ("c", 100.0, 90.0)], "series string, current_price double, predicted double")
    drivers = spark.createDataFrame([(k, -0.2, 15.0, None, 1.0) for k in "abc"], "series string, real_yield double, vix double, gone double, dollar double")
    x, flat, down = forecast.forecast_context(pred, drivers, keys=["series"], evidence=SPEC).orderBy("series").collect()
    assert (x.direction, x.change, round(x.change_pct, 9)) == ("UP", 2.0, 2.0)
    assert x.reasons == ["Real yield fell 0.20.", "Vix rose 15.00.", "Counter-signal: Dollar rose 1.00."]
    assert flat.direction == "FLAT" and flat.reasons == ["Real yield fell 0.20.", "Vix rose 15.00.", "Dollar rose 1.00."]
    assert down.reasons == ["Dollar rose 1.00.", "Counter-signal: Real yield fell 0.20.", "Counter-signal: Vix rose 15.00."]


def test_reasons_by_every_direction(spark):
    """Against the rule, plainly: support by strength, then what is left, marked; the largest for other directions."""
    import math
    import random

    rng, rows = random.Random(3), []
    for i in range(200):
        rows.append((i, rng.choice(["UP", "DOWN", "FLAT", None]), *(rng.choice([None, math.nan, math.inf, 0.0, -0.05, 0.2, 5.0, -30.0]) for _ in range(4))))
    df = spark.createDataFrame(rows, "id int, way string, real_yield double, vix double, gone double, dollar double")
    got = {r.id: r.reasons for r in forecast.top_reasons(forecast.driver_evidence(df, drivers=SPEC), toward="way").collect()}
    for i, way, *values in rows:
        found = [(max(-3, min(3, d.sign * v / d.scale)), f"{d.name} {'rose' if v > 0 or v == 0 and d.zero_rose else 'fell'} {abs(v):.2f}.") for d, v in zip(SPEC.values(), values, strict=True) if v is not None and math.isfinite(v)]
        strong = sorted(found, key=lambda e: -abs(e[0]))
        if way in ("UP", "DOWN"):
            turn = 1 if way == "UP" else -1
            want = [t for s, t in strong if turn * s > 0][:3]
            want += [f"Counter-signal: {t}" for s, t in strong if turn * s <= 0][: 3 - len(want)]
        else:
            want = [t for _, t in strong[:3]]
        assert got[i] == want


def test_sentences_with_signs_and_clauses(spark):
    spec = {"x": forecast.Driver(1.0, 1, "X", "X is {}{also}.", "X is {}{also}!", signed=True, also=("y", ", with Y at {}"))}
    df = spark.createDataFrame([(1, 1.5, 2.0), (2, -0.004, None), (3, -2.0, -0.5), (4, 0.0, float("nan"))], "i int, x double, y double")
    assert [r.evidence[0].text for r in forecast.driver_evidence(df, drivers=spec).orderBy("i").collect()] == ["X is +1.50, with Y at +2.00.", "X is -0.00!", "X is -2.00, with Y at -0.50!", "X is +0.00."]


def test_negative_gap_is_an_error(spark):
    with pytest.raises(ValueError, match="negative"):
        joins.ffill_bounded(bars(spark, 3), **BY, cols=["close"], max_gap_days=-1)


def test_fill_does_not_chain(spark):
    rows = [("a", DAY + dt.timedelta(days=i), x) for i, x in enumerate([1.0, None, None, None, 5.0])]
    df = joins.ffill_bounded(spark.createDataFrame(rows, "series string, date date, close double"), **BY, cols=["close"], max_gap_days=2)
    assert [x.close for x in df.orderBy("date").collect()] == [1.0, 1.0, 1.0, None, 5.0]


def test_upserts(spark):
    base, new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, note string, v double"), spark.createDataFrame([(2, None, None), (3, "c", 3.0)], "k int, note string, v double")
    key = lambda df: sorted(tuple(x) for x in df.collect())
    assert key(joins.upsert_full(base, new, on=["k"])) == [(1, "a", 1.0), (2, None, None), (3, "c", 3.0)]
    assert key(joins.upsert_subset(base, new, on=["k"], cols=["v"])) == [(1, "a", 1.0), (2, "b", None), (3, None, 3.0)]
    assert key(joins.upsert_ignore(base, new, on=["k"])) == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)]


def test_one_to_one_raises(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 5)], "k int, v int")
    with pytest.raises(ValueError, match="no partner"):
        joins.one_to_one(a, b, on=["k"])
    with pytest.raises(ValueError, match="unique"):
        joins.one_to_one(a, b.union(b), on=["k"])


def test_gate_lists_all_failures(spark):
    counts = spark.createDataFrame([("x", 0, 1), ("y", 5, 1), ("z", 3, 10)], "name string, rows int, minimum int")
    with pytest.raises(ValueError, match="x: 0 of 1 rows; z: 3 of 10 rows"):
        quality.refresh_gate(counts, strict=True)


def test_sparse_column_is_not_selected(spark):
    df = bars(spark, 40).withColumn("dxy", F.when(F.col("date") > DAY + dt.timedelta(days=34), 1.0))
    got = {x.column: x.selected for x in quality.feature_coverage(df, cols=["close", "dxy"]).collect()}
    assert got == {"close": True, "dxy": False}


def test_legacy_positioning_date(spark):
    raw = spark.createDataFrame([("GOLD", "88691", "100105.0", "1,000", "5", "x", 1), ("GOLD", "88691", "100105.0", "1,200", "6", "7", 2), ("SILVER", "84691", "100105.0", "1", "1", "1", 1)], "Market string, Code string, YYMMDD string, Open_Interest string, Longs string, Shorts string, arrival int")
    x = landing.normalise_positioning(raw, code="088691", arrival="arrival").collect()
    assert len(x) == 1 and (x[0].report_date, x[0].available_date, x[0].open_interest, x[0].code) == (dt.date(2010, 1, 5), dt.date(2010, 1, 8), 1200.0, "088691")
    with pytest.raises(ValueError, match="missing columns"):
        landing.normalise_positioning(raw.drop("Longs"), code=None, arrival="arrival")


def test_compact_dates_of_both_centuries(spark):
    raw = spark.createDataFrame([(t, "088691", t, "1", "1", "1", 1) for t in ("950109", "690101.0", "681231", "100105", "70104.0", "991340", None)], "Market string, Code string, YYMMDD string, Open_Interest string, Longs string, Shorts string, arrival int")
    got = {r.market: r.report_date for r in landing.normalise_positioning(raw, code=None, arrival="arrival").collect()}
    assert got == {"950109": dt.date(1995, 1, 9), "690101.0": dt.date(1969, 1, 1), "681231": dt.date(2068, 12, 31), "100105": dt.date(2010, 1, 5), "70104.0": dt.date(2007, 1, 4)}


def test_content_hash_sees_repeated_rows(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (2, "b"), (3, "b"), (3, "a"), (4, None), (5, "-"), (6, "b"), (6, "b")]
    got = {r.k: r["hash"] for r in analysis.content_hash(spark.createDataFrame(rows, "k int, x string"), by=["k"], cols=["x"]).collect()}
    assert got[1] == got[3] and len({got[k] for k in (1, 2, 4, 5, 6)}) == 5 and got[6] != "0"


def test_results_are_stored_once(spark):
    base = spark.createDataFrame([("r", "m", "test", 1, "mae", 1.0), ("r", "m", "test", 1, "rmse", 2.0)], "run_id string, model string, split string, horizon int, metric string, value double")
    new = spark.createDataFrame([("r", "m", "test", 1, "mae", 3.0, 1), ("r", "m", "test", 1, "mae", None, 2), ("r", "m", "test", 5, "mae", 4.0, 1)], base.schema.simpleString()[7:-1].replace(":", " ") + ", at int")
    once = forecast.upsert_results(base, new, table="metrics", arrival="at")
    want = [(1, "mae", None), (1, "rmse", 2.0), (5, "mae", 4.0)]
    for df in (once, forecast.upsert_results(once, new, table="metrics", arrival="at")):
        assert df.columns == base.columns and sorted((r.horizon, r.metric, r.value) for r in df.collect()) == want
    with pytest.raises(ValueError, match="needs"):
        forecast.upsert_results(base, new.drop("split"), table="metrics", arrival="at")


def test_holidays_of_known_years(spark):
    got = {(r.date.isoformat(), r.name) for r in forecast.federal_holidays(spark.createDataFrame([(2001,), (2022,)], "year int")).collect()}
    assert {("2001-11-12", "veterans"), ("2001-05-28", "memorial"), ("2001-11-22", "thanksgiving"), ("2022-06-20", "juneteenth"), ("2021-12-31", "new year"), ("2022-12-26", "christmas"), ("2022-01-17", "king"), ("2022-09-05", "labor")} <= got
    assert len(got) == 21


def test_short_histories_are_named(spark):
    df = spark.createDataFrame([("a", i) for i in range(30)] + [("b", i) for i in range(5)], "series string, x int")
    assert {r.series: (r.rows, r.needed, r.ok) for r in forecast.history_guard(df, keys=["series"], train=10, windows=1, horizon=5).collect()} == {"a": (30, 20, True), "b": (5, 20, False)}
    with pytest.raises(ValueError, match="'b'"):
        forecast.history_guard(df, keys=["series"], train=10, windows=1, horizon=5, strict=True)


def test_forecast_errors_are_single(spark):
    pred = spark.createDataFrame([("s", dt.date(2020, 1, 1), 1, "m", 11.0, 10.0), ("s", dt.date(2020, 1, 1), 2, "m", 8.0, 10.0), ("s", dt.date(2020, 1, 2), 1, "m", 9.0, None)], "series string, cutoff_date date, step int, model string, predicted double, actual_price double")
    runs = spark.createDataFrame([("r", "m")], "run_id string, selected_model string")
    got = {(r.step, r.metric): (r.value, r.n) for r in forecast.live_forecast_metrics(pred, runs).collect()}
    assert got == {(1, "rmse"): (1.0, 1), (1, "mae"): (1.0, 1), (1, "mape"): (10.0, 1), (2, "rmse"): (2.0, 1), (2, "mae"): (2.0, 1), (2, "mape"): (20.0, 1)}


def test_positional_and_zipped_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("GOLD,x,2020-01-07,088691\nSILVER,y,2020-01-07,084691\n")
    got = landing.read_positional(spark, str(tmp_path / "p.csv"), columns={0: "market", 3: "code"}).orderBy("market").collect()
    assert [tuple(x) for x in got] == [("GOLD", "088691"), ("SILVER", "084691")]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.txt", "market,code\nGOLD,088691\n")
    x = landing.read_zipped_csv(spark, str(tmp_path / "a.zip")).first()
    assert x["values"] == {"market": "GOLD", "code": "088691"}


@pytest.mark.parametrize(("now", "last"), [("2026-06-19 16:00:00", "2026-06-18"), ("2026-06-20 00:00:00", "2026-06-19")])
def test_complete_session(spark, now, last):
    days = spark.createDataFrame([(dt.date(2026, 6, d),) for d in range(15, 22)], "date date")
    got = landing.complete_sessions(days, time="date", now=F.lit(now).cast("timestamp")).agg(F.max("date")).first()[0]
    assert str(got) == last


def test_refresh_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    for _ in range(2):
        landing.write_tables({"raw": df, "history": df}, str(tmp_path / "t"), keep=("history",))
    assert (spark.read.parquet(str(tmp_path / "t/raw")).count(), spark.read.parquet(str(tmp_path / "t/history")).count()) == (1, 2)
    landing.write_report(df, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).first().v == "a"


def test_ridge_matches_normal_equations():
    r = np.random.default_rng(0)
    x, y = r.normal(size=(50, 3)), r.normal(size=50)
    x[3, 1] = np.nan
    m = forecast.ridge_fit(x, y, 20.0)
    z = (np.column_stack([np.where(np.isnan(x), m[0], x), np.isnan(x)]) - m[1]) / m[2]
    t, zc = (y - m[3]) / m[4], z - z.mean(0)
    assert np.allclose(zc.T @ (zc @ m[5] - (t - t.mean())) + 20.0 * m[5], 0)


def test_regime_grid_equals_plain_join(spark):
    df = analogs.future_returns(bars(spark, 800, ("a", "b")), **BY)
    got = analogs.regime(df, **BY, return_box=2.0, vol_box=0.05)
    h = got.select("series", F.col("date").alias("d"), F.col("ret_21").alias("r"), F.col("vol_21").alias("v"), F.col("future_5").alias("f"))
    plain = got.join(h, "series").where("d <= add_months(date, -12) and abs(ret_21 - r) <= 2.0 and abs(vol_21 - v) <= 0.05").groupBy("series", "date").agg(F.count("f").alias("n"))
    both = got.join(plain, ["series", "date"], "left").where("regime_n_5 != coalesce(n, 0)")
    assert both.count() == 0 and got.where("regime_n_5 > 0").count() > 0


def test_boosted_trees_learn_a_step():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 4))
    x[::9, 1] = np.nan
    y = 0.5 * (x[:, 0] > 0.3) + 0.3 * np.isnan(x[:, 1]) + 0.01 * rng.normal(size=800)
    m = forecast.gbt_fit(x, y, **forecast.TREES)
    assert len(m[2]) == 240 and np.mean((forecast.gbt_predict(m, x) - y) ** 2) < 0.05 * y.var()
    assert m[3][0] > m[3][2] + m[3][3] and m[3][1] > m[3][2] + m[3][3]


def test_boosted_trees_for_all_horizons(spark):
    from tidemark.plans import QUERIES

    sf = "/root/testdata/sf0.001"
    key = ["series", "cutoff_date", "step"]
    want = {tuple(r[k] for k in key) for r in QUERIES["ridge_forecasts"](spark, sf).collect()}
    got = QUERIES["gbt_forecasts"](spark, sf).collect()
    assert {tuple(r[k] for k in key) for r in got} == want and len(got) == len(want) and {r.step for r in got} == set(forecast.HORIZONS)
    total = {}
    for r in QUERIES["gbt_importance"](spark, sf).collect():
        total[r.series, r.horizon] = total.get((r.series, r.horizon), 0) + r.importance
    assert {h for _, h in total} == set(forecast.HORIZONS) and all(abs(x - 1) < 1e-9 or x == 0 for x in total.values())


def test_series_json_of_several_bodies(spark):
    body = lambda v: '{"observations": [{"date": "2020-01-01", "value": "%s"}]}' % v
    raw = spark.createDataFrame([("a", 2, body("5")), ("a", 10, body(".")), ("a", 1, body("7"))], "series string, page long, body string")
    assert [r.value for r in landing.normalise_series_json(raw, series="series", body="body", page="page").collect()] == [5.0]


def test_pages_have_all_events(spark, monkeypatch):
    from tidemark.plans import QUERIES

    seen, real = [], landing.normalise_paged_json
    monkeypatch.setattr(landing, "normalise_paged_json", lambda pages, **kw: seen.append(pages) or real(pages, **kw))
    QUERIES["norm_paged_union"](spark, "/root/testdata/sf0.001")
    data = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = seen[0].select(F.explode(F.from_json("body", "response struct<data: array<struct<value: string>>>")["response"]["data"]).alias("x")).select("x.value")
    assert got.count() == data.count() and got.where("value = '.'").count() == data.where("event_id % 10 = 0").count()
