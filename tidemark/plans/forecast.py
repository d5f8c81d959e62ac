"""Queries of forecast evaluation, on naive models that SQL can express, and of the fitted models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import stored_columns
from ..functions.windows import NUDGE, ordered
from ..operators import forecast as op
from ..operators import joins, projections
from . import views
from .indicators import BY, ID, over
from .projections import pct
from .registry import query, r, shown

_W = "PARTITION BY series ORDER BY date"
_ORIGINS = f""", n AS (SELECT *, row_number() OVER ({_W}) - 1 AS row, count(*) OVER (PARTITION BY series) AS n FROM bars),
o AS (SELECT c.series, CAST(6 - (c.n - 1 - c.row) / 10 AS INTEGER) AS "window", c.row AS cutoff_row, c.date AS cutoff_date, c.close AS current_price, CAST(f.row - c.row AS INTEGER) AS step, f.date AS forecast_date, f.open AS actual_price
    FROM n c JOIN n f ON f.series = c.series AND f.row BETWEEN c.row + 1 AND c.row + 10 WHERE (c.n - 1 - c.row) % 10 = 0 AND c.n - 1 - c.row BETWEEN 1 AND 60)"""


@query("rolling_origins", _ORIGINS + " SELECT * FROM o")
def rolling_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rolling_origins(views.bars(spark, sf_dir), **BY)


@query("training_bounds", _ORIGINS + ' SELECT series, "window", step, cutoff_row, cutoff_row - step AS train_end, greatest(0, cutoff_row - step - 1259) AS train_start, cutoff_row - step - greatest(0, cutoff_row - step - 1259) + 1 AS train_rows FROM o')
def training_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.training_bounds(op.rolling_origins(views.bars(spark, sf_dir), **BY)).select("series", "window", "step", "cutoff_row", "train_end", "train_start", "train_rows")


_T = {f"target_{h}": f"ln(lead(open, {h}) OVER ({_W})) - ln(close)" for h in op.HORIZONS}


@query("direct_target", f"SELECT series, date, {r(6, **_T)}, {r(4, price_5='close * exp(' + _T['target_5'] + ')')} FROM bars_gaps")
def direct_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.direct_target(views.bars_gaps(spark, sf_dir), **BY, horizons=op.HORIZONS)
    return shown(shown(df, [*ID, *_T], ["price_5"]), [*ID, "price_5"], [*_T], 6)


@query("future_calendar", ", f AS (" + " UNION ALL ".join(f"SELECT series, date, {h} AS step, lead(date, {h}) OVER ({_W}) AS forecast_date FROM bars" for h in op.HORIZONS) + f") SELECT series, date, step, forecast_date, CAST(forecast_date - date AS INTEGER) AS gap_days, {r(6, month_sin='sin(2 * pi() * month(forecast_date) / 12)', day_cos='cos(2 * pi() * dayofyear(forecast_date) / 365.25)')} FROM f WHERE forecast_date IS NOT NULL")
def future_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.future_calendar(views.bars(spark, sf_dir), **BY, horizons=op.HORIZONS), [*ID, "step", "forecast_date", "gap_days"], ["month_sin", "day_cos"], 6)


_NTH = "make_date(y, {m}, 1) + CAST(({wd} - isodow(make_date(y, {m}, 1)) + 7) % 7 + {n} AS INTEGER)"
_OBSERVED = "CASE isodow(make_date(y, {m}, {d})) WHEN 6 THEN make_date(y, {m}, {d}) - 1 WHEN 7 THEN make_date(y, {m}, {d}) + 1 ELSE make_date(y, {m}, {d}) END"
_DAYS = {
    "new year": _OBSERVED.format(m=1, d=1), "king": _NTH.format(m=1, wd=1, n=14), "presidents": _NTH.format(m=2, wd=1, n=14), "memorial": "make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER)",
    "juneteenth": "CASE WHEN y >= 2021 THEN " + _OBSERVED.format(m=6, d=19) + " END", "independence": _OBSERVED.format(m=7, d=4), "labor": _NTH.format(m=9, wd=1, n=0), "columbus": _NTH.format(m=10, wd=1, n=7),
    "veterans": _OBSERVED.format(m=11, d=11), "thanksgiving": _NTH.format(m=11, wd=4, n=21), "christmas": _OBSERVED.format(m=12, d=25),
}
_YEARS = "SELECT DISTINCT year(date) + k AS y FROM {0}, (VALUES (0), (1)) v(k)"
_HOLIDAYS = "hy AS ({years}), hd AS (" + " UNION ALL ".join(f"SELECT {e} AS date, '{n}' AS name FROM hy" for n, e in _DAYS.items()) + "), h AS (SELECT * FROM hd WHERE date IS NOT NULL)"


def _holidays(dates: DataFrame) -> DataFrame:
    """The holidays of all years in ``dates`` and the years after."""
    years = dates.select(F.year("date").alias("year")).distinct()
    return op.federal_holidays(years.select(F.explode(F.array("year", F.col("year") + 1)).alias("year")).distinct())


@query("federal_holidays", ", " + _HOLIDAYS.format(years=_YEARS.format("(SELECT date FROM bars UNION SELECT date + INTERVAL 25 YEAR FROM bars)")) + " SELECT date, name FROM h")
def federal_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the tables' years, and of those 25 years later."""
    b = views.bars(spark, sf_dir).select("date")
    return _holidays(b.unionByName(b.select(F.add_months("date", 300).alias("date"))))


@query("next_sessions", ", " + _HOLIDAYS.format(years=_YEARS.format("bars_many")) + ", l AS (SELECT series, max(date) AS date FROM bars_many GROUP BY series), a AS (SELECT series, CAST(unnest(generate_series(date + 1, date + 34, INTERVAL 1 DAY)) AS DATE) AS d FROM l) SELECT series, CAST(row_number() OVER (PARTITION BY series ORDER BY d) AS INTEGER) AS step, d AS forecast_date FROM a WHERE isodow(d) < 6 AND d NOT IN (SELECT date FROM h) QUALIFY row_number() OVER (PARTITION BY series ORDER BY d) <= 10")
def next_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = views.bars_many(spark, sf_dir)
    return op.next_sessions(b.groupBy("series").agg(F.max("date").alias("date")), _holidays(b), **BY)


@query("history_guard", " SELECT series, count(*) AS rows, CAST(200 AS BIGINT) AS needed, count(*) >= 200 AS ok FROM bars_many GROUP BY series")
def history_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.history_guard(views.bars_many(spark, sf_dir), keys=["series"], train=130)


_ME = "predicted - actual_price"
_MSQL = {"rmse": f"sqrt(avg(({_ME}) * ({_ME})))", "mae": f"avg(abs({_ME}))", "mape": f"avg(100 * abs({_ME}) / nullif(abs(actual_price), 0))", "smape": f"avg(100 * abs({_ME}) / nullif((abs(actual_price) + abs(predicted)) / 2, 0))", "nrmse": f"100 * sqrt(avg(({_ME}) * ({_ME}))) / avg(actual_price)", "direction": "avg(CASE WHEN sign(predicted - current_price) = sign(actual_price - current_price) THEN 100.0 ELSE 0.0 END)"}
_STEPS = "step IN (1, 3, 5, 7, 10) AND actual_price IS NOT NULL"


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.forecast_metrics(views.naive_predictions(spark, sf_dir), by=["model", "step"], horizons=op.HORIZONS)


@query("forecast_metrics", f"SELECT model, step, count(*) AS n, {r(3, **_MSQL)} FROM naive_predictions WHERE {_STEPS} GROUP BY model, step")
def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_metrics(spark, sf_dir), ["model", "step", "n"], op.METRICS, 3)


_M = f", m AS (SELECT model, step, count(*) AS n, {', '.join(f'{e} AS {n}' for n, e in _MSQL.items())} FROM naive_predictions WHERE {_STEPS} GROUP BY model, step)"


@query("leaderboard", _M + f", l AS (SELECT model, {', '.join(f'avg({c}) AS {c}' for c in op.METRICS)} FROM m GROUP BY model) SELECT model, {r(3, **{c: c for c in op.METRICS})}, row_number() OVER (ORDER BY rmse, mae, model) = 1 AS selected FROM l")
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.leaderboard(_metrics(spark, sf_dir)), ["model", "selected"], op.METRICS, 3)


@query("metric_unpivot", _M + " SELECT model, step, n, metric, round(value + 3.3e-9, 3) + 0.0 AS value FROM (" + " UNION ALL ".join(f"SELECT model, step, n, '{c}' AS metric, {c} AS value FROM m" for c in op.METRICS) + ") x")
def metric_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(joins.unpivot_metrics(_metrics(spark, sf_dir).select("model", "step", "n", *op.METRICS), ids=["model", "step", "n"], metrics=op.METRICS), ["model", "step", "n", "metric"], ["value"], 3)


_KEY = ["series", "cutoff_date", "forecast_date", "step"]
_KEYS = ", ".join(_KEY)


@query("predictions_wide", f"SELECT {_KEYS}, {r(6, last_close='max(predicted) FILTER (WHERE model = ' + chr(39) + 'last_close' + chr(39) + ')', sma20='max(predicted) FILTER (WHERE model = ' + chr(39) + 'sma20' + chr(39) + ')')} FROM naive_predictions GROUP BY {_KEYS}")
def predictions_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.predictions_wide(views.naive_predictions(spark, sf_dir), ids=_KEY, models=["last_close", "sma20"]), _KEY, ["last_close", "sma20"], 6)


@query("blend_predictions", f"SELECT {_KEYS}, 'blend' AS model, {r(6, predicted='avg(predicted)')} FROM naive_predictions GROUP BY {_KEYS}")
def blend_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.blend(views.naive_predictions(spark, sf_dir), ids=_KEY), [*_KEY, "model"], ["predicted"], 6)


_Q = "SELECT series, model, step, quantile_cont(abs(actual_price - predicted), 0.8) AS q80, quantile_cont(abs(actual_price - predicted), 0.95) AS q95 FROM naive_predictions WHERE actual_price IS NOT NULL GROUP BY 1, 2, 3"


@query("prediction_intervals", f", q AS ({_Q}), l AS (SELECT * FROM naive_predictions QUALIFY cutoff_date = max(cutoff_date) OVER (PARTITION BY series, step)) SELECT l.series, l.model, l.step, {r(3, predicted='predicted', lower_80='predicted - q80', upper_80='predicted + q80', lower_95='predicted - q95', upper_95='predicted + q95')} FROM l LEFT JOIN q USING (series, model, step)")
def prediction_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.naive_predictions(spark, sf_dir)
    last = p.groupBy("series", "step").agg(F.max("cutoff_date").alias("cutoff_date"))
    df = op.prediction_intervals(p.join(last, ["series", "step", "cutoff_date"], "left_semi"), p, by=["series", "model", "step"])
    return shown(df, ["series", "model", "step"], ["predicted", "lower_80", "upper_80", "lower_95", "upper_95"], 3)


_DIRECTION = "CASE WHEN 100 * (predicted / current_price - 1) > 0.05 THEN 'UP' WHEN 100 * (predicted / current_price - 1) < -0.05 THEN 'DOWN' WHEN predicted IS NOT NULL THEN 'FLAT' END"


@query("forecast_direction", f"SELECT series, cutoff_date, step, model, {_DIRECTION} AS direction FROM naive_predictions")
def forecast_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.naive_predictions(spark, sf_dir).select("series", "cutoff_date", "step", "model", op.direction(F.col("current_price"), F.col("predicted")).alias("direction"))


DRIVERS = {
    "change_5": op.Driver(40.0, 1, "5-day change", "The price rose {}% over five sessions{also}, a following wind.", "The price fell {}% over five sessions{also}, a head wind.", also=("volume_score", ", with volume at {} deviations")),
    "gap": op.Driver(60.0, -1, "Gap", "The open was {}% above the close before, which tends to be given back.", "The open was {}% below the close before, which tends to be made good.", zero_rose=False),
    "volume_score": op.Driver(1.0, 1, "Volume score", "Volume is {} deviations from its 21-session mean, supporting demand.", "Volume is {} deviations from its 21-session mean, weakening demand.", zero_rose=False, signed=True),
    "range": op.Driver(50.0, -1, "Range", "The range was {}% of the open, a sign of stress.", "The range was {}% of the open, a sign of calm.", zero_rose=False),
}
_DRV = f""", d0 AS (SELECT series, date, close, {pct('close', f'lag(close, 5) OVER ({_W})')} + {NUDGE} AS change_5, {pct('open', f'lag(close) OVER ({_W})')} + {NUDGE} AS gap, CASE WHEN {over('stddev_samp(volume)', 21)} > 0 THEN (volume - {over('avg(volume)', 21)}) / {over('stddev_samp(volume)', 21)} END + {NUDGE} AS volume_score,
CASE WHEN open > 0 THEN 100 * (high - low) / open END + {NUDGE} AS "range" FROM bars)"""
_SIZE = lambda c: f"CAST(CAST(round(abs(\"{c}\"), 2) AS DECIMAL(30, 2)) AS VARCHAR)"
_SIGNED = lambda c: f"CASE WHEN \"{c}\" < 0 THEN '-' ELSE '+' END || {_SIZE(c)}"
_TEXT = {
    "change_5": f"'The price ' || CASE WHEN change_5 >= 0 THEN 'rose ' ELSE 'fell ' END || {_SIZE('change_5')} || '% over five sessions' || CASE WHEN volume_score IS NULL THEN '' ELSE ', with volume at ' || {_SIGNED('volume_score')} || ' deviations' END || CASE WHEN change_5 >= 0 THEN ', a following wind.' ELSE ', a head wind.' END",
    "gap": f"'The open was ' || {_SIZE('gap')} || CASE WHEN gap > 0 THEN '% above the close before, which tends to be given back.' ELSE '% below the close before, which tends to be made good.' END",
    "volume_score": f"'Volume is ' || {_SIGNED('volume_score')} || ' deviations from its 21-session mean, ' || CASE WHEN volume_score > 0 THEN 'supporting demand.' ELSE 'weakening demand.' END",
    "range": f"'The range was ' || {_SIZE('range')} || CASE WHEN \"range\" > 0 THEN '% of the open, a sign of stress.' ELSE '% of the open, a sign of calm.' END",
}
_LONG = " UNION ALL ".join(f"SELECT series, date, {i} AS no, '{d.name}' AS driver, greatest(-3, least(3, {d.sign} * \"{c}\" / {d.scale})) AS score, {_TEXT[c]} AS text FROM d0 WHERE \"{c}\" IS NOT NULL" for i, (c, d) in enumerate(DRIVERS.items()))


def _reasons_sql(rows: str, by: str, direction: str) -> str:
    """The three reasons of each row: support first for UP and DOWN, then marked counter-signals; the largest scores for others."""
    against = f"coalesce(CASE {direction} WHEN 'UP' THEN score <= 0 WHEN 'DOWN' THEN score >= 0 END, FALSE)"
    return f"(SELECT {by}, string_agg(CASE WHEN {against} THEN 'Counter-signal: ' ELSE '' END || text, ' / ' ORDER BY rn) AS reasons FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {against}, -abs(score), no) AS rn FROM {rows}) k WHERE rn <= 3 GROUP BY {by})"


def _drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = projections.bar_shape(projections.pct_change_k(projections.rolling_zscore(views.bars(spark, sf_dir), **BY, col="volume", n=21), **BY, col="close", steps=[5]), **BY)
    return b.select(*ID, *((F.col(c) + NUDGE).alias(n) for c, n in (("close_change_5", "change_5"), ("gap_pct", "gap"), ("volume_zscore_21", "volume_score"), ("range_pct", "range"))))


@query("driver_evidence", _DRV + f" SELECT series, date, driver, text, {r(score='score')} FROM ({_LONG}) x")
def driver_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.driver_evidence(_drivers(spark, sf_dir), drivers=DRIVERS).select(*ID, F.explode("evidence").alias("e")).select(*ID, "e.driver", "e.text", "e.score")
    return shown(df, [*ID, "driver", "text"], ["score"])


_DAY_DIRECTION = "CASE WHEN day(date) % 7 = 0 THEN NULL ELSE CASE day(date) % 3 WHEN 0 THEN 'UP' WHEN 1 THEN 'DOWN' ELSE 'FLAT' END END"


@query("top_reasons", _DRV + f", e AS (SELECT *, {_DAY_DIRECTION} AS direction FROM ({_LONG}) x) SELECT series, date, direction, reasons FROM {_reasons_sql('e', 'series, date, direction', 'direction')} y")
def top_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For rising, falling, flat and unknown directions."""
    day = F.dayofmonth("date")
    df = op.driver_evidence(_drivers(spark, sf_dir), drivers=DRIVERS).where(F.size("evidence") > 0)
    df = op.top_reasons(df.withColumn("direction", F.when(day % 7 != 0, F.when(day % 3 == 0, "UP").when(day % 3 == 1, "DOWN").otherwise("FLAT"))), toward="direction")
    return df.select(*ID, "direction", F.array_join("reasons", " / ").alias("reasons"))


@query("forecast_context", _DRV + f""", l AS (SELECT * FROM naive_predictions QUALIFY cutoff_date = max(cutoff_date) OVER (PARTITION BY series, step)), x AS (SELECT *, {_DIRECTION} AS direction FROM l WHERE model = 'sma20'),
e AS (SELECT z.*, x.step, x.direction FROM ({_LONG}) z JOIN x ON x.series = z.series WHERE (z.series, z.date) IN (SELECT (series, max(date)) FROM bars GROUP BY series)),
g AS (SELECT series, step, reasons FROM {_reasons_sql('e', 'series, step, direction', 'direction')} y) SELECT x.series, x.step, x.direction, g.reasons, 'driver scores' AS method, {r(change='predicted - current_price', change_pct='100 * (predicted / current_price - 1)')} FROM x LEFT JOIN g USING (series, step)""")
def forecast_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.naive_predictions(spark, sf_dir).where("model = 'sma20'")
    p = p.join(p.groupBy("series", "step").agg(F.max("cutoff_date").alias("cutoff_date")), ["series", "step", "cutoff_date"], "left_semi")
    d = _drivers(spark, sf_dir)
    d = d.groupBy("series").agg(F.max_by(F.struct(*DRIVERS), "date").alias("x")).select("series", "x.*")
    df = op.forecast_context(p, d, keys=["series"], evidence=DRIVERS).withColumn("reasons", F.array_join("reasons", " / "))
    return shown(df, ["series", "step", "direction", "reasons", "method"], ["change", "change_pct"])


_BLANK = "CASE WHEN step % 3 <> 0 THEN actual_price END"


@query("reconcile_actuals", f"SELECT p.series, p.cutoff_date, p.forecast_date, p.step, p.model, coalesce({_BLANK}, b.open) AS actual_price FROM naive_predictions p LEFT JOIN (SELECT series, date, open FROM bars WHERE date < DATE '2001-06-01') b ON b.series = p.series AND b.date = p.forecast_date")
def reconcile_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.naive_predictions(spark, sf_dir).withColumn("actual_price", F.when(F.col("step") % 3 != 0, F.col("actual_price")))
    known = views.bars(spark, sf_dir).where("date < date'2001-06-01'").withColumnRenamed("date", "forecast_date")
    return op.reconcile(p, known, on=["series", "forecast_date"]).select("series", "cutoff_date", "forecast_date", "step", "model", "actual_price")


_LM = f", e AS (SELECT run_id, model, step, {_ME} AS e, actual_price FROM naive_predictions JOIN runs ON selected_model = model WHERE actual_price IS NOT NULL), g AS (SELECT run_id, model, step, count(*) AS n, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(100 * abs(e) / nullif(actual_price, 0)) AS mape FROM e GROUP BY ALL UNION ALL SELECT run_id, model, 0, count(*), sqrt(avg(e * e)), avg(abs(e)), avg(100 * abs(e) / nullif(actual_price, 0)) FROM e GROUP BY ALL)"


@query("live_metrics", _LM + " SELECT run_id, model, step, n, metric, round(value + 3.3e-9, 3) + 0.0 AS value FROM (" + " UNION ALL ".join(f"SELECT run_id, model, step, n, '{m}' AS metric, {m} AS value FROM g" for m in ("rmse", "mae", "mape")) + ") x")
def live_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.live_metrics(views.naive_predictions(spark, sf_dir), views.runs(spark)), ["run_id", "model", "step", "n", "metric"], ["value"], 3)


_LE = f", e AS (SELECT run_id, model, series, cutoff_date, step, abs({_ME}) AS mae, sqrt(({_ME}) * ({_ME})) AS rmse, 100 * abs({_ME}) / nullif(actual_price, 0) AS mape FROM naive_predictions JOIN runs ON selected_model = model WHERE actual_price IS NOT NULL)"
_LL = " UNION ALL ".join(f"SELECT run_id, model, series, cutoff_date, step, CAST(1 AS BIGINT) AS n, '{m}' AS metric, {m} AS value FROM e" for m in ("rmse", "mae", "mape"))
_LIVE = ["run_id", "model", "series", "cutoff_date", "step", "n", "metric"]


@query("live_forecast_metrics", _LE + f" SELECT {', '.join(_LIVE)}, round(value + 3.3e-9, 3) + 0.0 AS value FROM ({_LL}) x")
def live_forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.live_forecast_metrics(views.naive_predictions(spark, sf_dir), views.runs(spark)), _LIVE, ["value"], 3)


@query("live_metric_upsert", _LE + f", x AS ({_LL}) SELECT {', '.join(_LIVE)}, round(CASE WHEN cutoff_date < DATE '1997-01-01' THEN value ELSE value + 2 END + 3.3e-9, 3) + 0.0 AS value FROM x WHERE step < 9 OR cutoff_date >= DATE '1997-01-01'")
def live_metric_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store holds steps under 9; rows from 1997 on come twice more, of which the later ones count. The second run changes nothing."""
    rows = op.live_forecast_metrics(views.naive_predictions(spark, sf_dir), views.runs(spark))
    late = rows.where("cutoff_date >= date'1997-01-01'")
    new = late.withColumns({"arrival": F.lit(1), "value": F.col("value") + 1}).unionByName(late.withColumns({"arrival": F.lit(2), "value": F.col("value") + 2}))
    store = rows.where("step < 9")
    for _ in range(2):
        store = op.upsert_results(store, new, table="live_metrics", arrival="arrival")
    return shown(store, _LIVE, ["value"], 3)


_RM = _M + ", k AS (SELECT selected_model AS model, run_id FROM runs), o AS (" + " UNION ALL ".join(f"SELECT k.run_id, m.model, 'test' AS split, m.step AS horizon, '{c}' AS metric, m.{c} AS value, m.n FROM m JOIN k USING (model)" for c in op.METRICS) + ")"


@query("result_store", _RM + " SELECT run_id, model, split, horizon, metric, n, round(CASE WHEN metric <> 'mae' THEN value * 2 ELSE value END + 3.3e-9, 3) + 0.0 AS value FROM o")
def result_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of each run by (run, model, split, horizon, metric): the store of a first evaluation takes the rows of a second one."""
    m = joins.unpivot_metrics(_metrics(spark, sf_dir).select("model", "step", "n", *op.METRICS), ids=["model", "step", "n"], metrics=op.METRICS)
    runs = views.runs(spark).withColumnRenamed("selected_model", "model")
    rows = m.join(runs, "model").select("run_id", "model", F.lit("test").alias("split"), F.col("step").alias("horizon"), "metric", "value", "n")
    new = rows.where("metric <> 'mae'").withColumns({"value": F.col("value") * 2, "arrival": F.lit(1)})
    store = op.upsert_results(rows.where("metric in ('mae', 'rmse')"), new, table="metrics", arrival="arrival")
    return shown(store, ["run_id", "model", "split", "horizon", "metric", "n"], ["value"], 3)


@query("sequence_frame", f", f AS (SELECT series, date, CASE WHEN close > 0 THEN ln(close) END AS y, last_value(open IGNORE NULLS) OVER ({_W}) AS open, last_value(volume IGNORE NULLS) OVER ({_W}) AS volume FROM bars_gaps) SELECT series, date, row_number() OVER ({_W}) - 1 AS time_idx, {r(6, y='y')}, open, volume FROM f WHERE y IS NOT NULL AND open IS NOT NULL AND volume IS NOT NULL")
def sequence_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.sequence_frame(views.bars_gaps(spark, sf_dir), **BY, cols=["open", "volume"]), [*ID, "time_idx", "open", "volume"], ["y"], 6)


@query("json_params", "SELECT run_id, '{\"model\":\"' || selected_model || '\",\"windows\":6}' AS params, selected_model AS model, 6 AS windows, count(*) AS n FROM runs JOIN naive_predictions ON model = selected_model GROUP BY ALL")
def json_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of a run as JSON text and read back, with its predictions counted."""
    runs = views.runs(spark).withColumn("params", F.to_json(F.struct(F.col("selected_model").alias("model"), F.lit(6).alias("windows"))))
    n = views.naive_predictions(spark, sf_dir).groupBy("model").agg(F.count("*").alias("n"))
    df = runs.join(n, F.col("model") == F.col("selected_model")).withColumn("p", F.from_json("params", "model string, windows int"))
    return df.select("run_id", "params", "p.model", "p.windows", "n")


RIDGE_COLS = ["log_return", "log_gap", "log_intraday", "price_to_mean_21", "return_sd_21", "volume_zscore_21"]


def ridge_features(spark: SparkSession, sf_dir: str, bars: Callable[[SparkSession, str], DataFrame] = views.bars) -> DataFrame:
    b = bars(spark, sf_dir)
    df = projections.volume_zscore(projections.rolling_return_stats(projections.log_bar_features(b, **BY), **BY, spans=(21,)), **BY, spans=(21,))
    df = op.direct_target(df, **BY, horizons=op.HORIZONS)
    return df.withColumn("row", (F.row_number().over(ordered(["series"], "date")) - 1).cast("long")).select("series", "row", *RIDGE_COLS, *(f"target_{h}" for h in op.HORIZONS))


@query("ridge_forecasts")
def ridge_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robust ridge for each (series, cutoff, step) on the rows before it."""
    bounds = op.training_bounds(op.rolling_origins(views.bars(spark, sf_dir), **BY))
    return op.ridge_forecasts(ridge_features(spark, sf_dir), bounds, keys=["series"], cols=RIDGE_COLS)


@query("ridge_forecasts_many")
def ridge_forecasts_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every supplier's series, from its last cutoff. Only lines are shuffled, once and by series; the few forecasts are stored."""
    return stored_columns(_ridge_many(views.bars_many(spark, sf_dir, dealt=True)))


def _ridge_many(bars: DataFrame) -> DataFrame:
    """``ridge_features`` and fits of bars that are dealt by series: windows of 21 rows are made within a series' group."""
    df = op.direct_target(projections.log_bar_features(bars, **BY), **BY, horizons=op.HORIZONS)
    df = df.withColumns({"row": (F.row_number().over(ordered(["series"], "date")) - 1).cast("long"), "_x": F.col("close").cast("double"), "_v": projections.log_volume()})
    rows = op.with_folds(df, **BY, horizons=op.HORIZONS, windows=1, before=20)
    return op.ridge_forecasts_within(rows, **BY, cols=RIDGE_COLS, steps=projections.return_steps(21))


@query("production_forecast")
def production_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ridge from each series' last row, with its date and direction."""
    b = views.bars(spark, sf_dir)
    made = op.ridge_forecasts(ridge_features(spark, sf_dir), op.production_bounds(b, **BY, horizons=op.HORIZONS), keys=["series"], cols=RIDGE_COLS)
    days = op.next_sessions(b.groupBy("series").agg(F.max("date").alias("date")), _holidays(b), **BY)
    df = made.drop("actual_price").join(days, ["series", "step"])
    return df.withColumn("direction", op.direction(F.col("current_price"), F.col("predicted")))


@query("gbt_forecasts")
def gbt_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees for each (series, cutoff, step) on the rows before it, with the importance of each feature in every fit."""
    bounds = op.training_bounds(op.rolling_origins(views.bars(spark, sf_dir), **BY))
    made = op.gbt_forecasts(ridge_features(spark, sf_dir), bounds, keys=["series"], cols=RIDGE_COLS)
    return made.withColumn("importance", F.map_from_arrays(F.array(*map(F.lit, RIDGE_COLS)), "importance"))


@query("gbt_importance")
def gbt_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each feature in the boosted trees of each series and horizon that forecast from its last row."""
    bounds = op.production_bounds(views.bars(spark, sf_dir), **BY, horizons=op.HORIZONS)
    made = op.gbt_forecasts(ridge_features(spark, sf_dir), bounds, keys=["series"], cols=RIDGE_COLS).where("importance is not null")
    names = F.array(*map(F.lit, RIDGE_COLS))
    return made.select("series", F.col("step").alias("horizon"), F.posexplode("importance").alias("at", "importance")).select("series", "horizon", F.get(names, F.col("at")).alias("feature"), "importance")
