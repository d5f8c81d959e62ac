"""Queries of the projections and calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import projections as op
from . import views
from .indicators import BY, ID, over
from .registry import query, r, shown

_W = "PARTITION BY series ORDER BY date"
_LAG = f"lag(close) OVER ({_W})"
WIDE = {"keys": [], "time": "date"}


def pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN 100 * ({a} / ({b}) - 1) END"


def div(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN ({a}) / ({b}) END"


@query("macro_projection", f"SELECT date, {r(yield_slope='coalesce(CASE WHEN day(date) % 3 = 0 THEN r_close END, n_close - a_close)')} FROM bars_wide")
def macro_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.bars_wide(spark, sf_dir).withColumn("slope", F.when(F.dayofmonth("date") % 3 == 0, F.col("r_close")))
    return shown(op.macro_projection(df, short="a_close", long="n_close", slope="slope"), ["date"], ["yield_slope"])


@query("ratio_features", f"SELECT date, {r(ratio_n=div('a_close', 'n_close'), spread_n='a_close - n_close', ratio_r=div('a_close', 'r_close'), spread_r='a_close - r_close')} FROM bars_wide")
def ratio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.ratio_features(views.bars_wide(spark, sf_dir), primary="a_close", others={"n": "n_close", "r": "r_close"})
    return shown(df, ["date"], ["ratio_n", "spread_n", "ratio_r", "spread_r"])


@query("bar_shape", f"SELECT series, date, {r(gap_pct=pct('open', _LAG), intraday_pct=pct('close', 'open'), range_pct=div('100 * (high - low)', 'open'), close_location=div('close - low', 'high - low'))} FROM bars_gaps")
def bar_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.bar_shape(views.bars_gaps(spark, sf_dir), **BY), ID, ["gap_pct", "intraday_pct", "range_pct", "close_location"])


_L = lambda k: f"lag(close, {k}) OVER ({_W})"


@query("pct_change_k", f"SELECT series, date, {r(close_change_1=pct('close', _L(1)), close_change_5=pct('close', _L(5)), close_diff_1='close - ' + _L(1), close_diff_5='close - ' + _L(5))} FROM bars")
def pct_change_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.pct_change_k(views.bars(spark, sf_dir), **BY, col="close", steps=[1, 5]), ID, ["close_change_1", "close_change_5", "close_diff_1", "close_diff_5"])


_P = "PARTITION BY contract ORDER BY report_date"
_POS = f""", a AS (SELECT *, longs - shorts AS net, {div('100 * (longs - shorts)', 'open_interest')} AS pct FROM positioning),
b AS (SELECT *, avg(pct) OVER ({_P} ROWS 51 PRECEDING) AS m, stddev_samp(pct) OVER ({_P} ROWS 51 PRECEDING) AS s, lag(net) OVER ({_P}) AS before FROM a)"""


@query("positioning_features", _POS + f" SELECT contract, report_date, available_date, CAST(available_date - report_date AS BIGINT) AS age_days, {r(net='net', net_pct_oi='pct', net_change_pct_oi=div('100 * (net - before)', 'open_interest'), net_zscore=div('pct - m', 's'))} FROM b")
def positioning_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.positioning_features(views.positioning(spark, sf_dir), keys=["contract"], time="report_date", as_of="available_date").withColumn("age_days", F.col("age_days").cast("long"))
    return shown(df, ["contract", "report_date", "available_date", "age_days"], ["net", "net_pct_oi", "net_change_pct_oi", "net_zscore"])


@query("calendar_parts", "SELECT series, date, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter, CAST(week(date) AS INTEGER) AS week, CAST(dayofyear(date) AS INTEGER) AS day_of_year FROM bars")
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.calendar_parts(views.bars(spark, sf_dir), time="date").select(*ID, "month", "quarter", "week", "day_of_year")


@query("calendar_cyclic", f"SELECT series, date, {r(6, month_sin='sin(2 * pi() * month(date) / 12)', month_cos='cos(2 * pi() * month(date) / 12)', day_sin='sin(2 * pi() * dayofyear(date) / 365.25)', day_cos='cos(2 * pi() * dayofyear(date) / 365.25)')} FROM bars")
def calendar_cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.calendar_cyclic(views.bars(spark, sf_dir), time="date"), ID, ["month_sin", "month_cos", "day_sin", "day_cos"], 6)


_Q = "CAST(date_trunc('quarter', date) AS DATE)"


@query("calendar_progress", f"SELECT series, date, {r(month_progress='(day(date) - 1) / day(last_day(date))', quarter_progress=f'(date - {_Q}) / (CAST({_Q} + INTERVAL 3 MONTH AS DATE) - {_Q})', year_progress='(dayofyear(date) - 1) / 365.25')}, CAST(make_date(CAST(year(date) + 1 AS INTEGER), 1, 1) - date AS INTEGER) AS days_to_new_year FROM bars")
def calendar_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.calendar_progress(views.bars(spark, sf_dir), time="date"), [*ID, "days_to_new_year"], ["month_progress", "quarter_progress", "year_progress"])


_RET = f"ln(close) - ln({_LAG})"


@query("log_bar_features", f"SELECT series, date, {r(6, log_return=_RET, log_gap=f'ln(open) - ln({_LAG})', log_intraday='ln(close) - ln(open)')} FROM bars_gaps")
def log_bar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.log_bar_features(views.bars_gaps(spark, sf_dir), **BY), ID, ["log_return", "log_gap", "log_intraday"], 6)


LAGS = (1, 2, 3, 5, 10, 21, 63, 126, 252)


@query("log_return_lags", f", x AS (SELECT *, {_RET} AS ret FROM bars) SELECT series, date, {r(6, log_return='ret', **{f'log_return_lag_{k}': f'lag(ret, {k}) OVER ({_W})' for k in LAGS})} FROM x")
def log_return_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.log_return_lags(views.bars(spark, sf_dir), **BY), ID, ["log_return", *(f"log_return_lag_{k}" for k in LAGS)], 6)


def _full(e: str, c: str, n: int) -> str:
    return f"CASE WHEN {over(f'count({c})', n)} = {n} THEN {e} END"


_STATS = {}
for _n in (5, 10, 21, 63, 126, 252):
    _STATS |= {f"return_{a}_{_n}": _full(over(f"{f}(ret)", _n), "ret", _n) for a, f in (("mean", "avg"), ("sd", "stddev_samp"), ("min", "min"), ("max", "max"))}
    _STATS |= {f"{a}_{_n}": _full(pct("close", over(f"{f}(close)", _n)), "close", _n) for a, f in (("price_to_mean", "avg"), ("drawdown", "max"), ("rebound", "min"))}
    _STATS[f"slope_{_n}"] = f"(ln(close) - ln(lag(close, {_n}) OVER ({_W}))) / {_n}"


@query("rolling_return_stats", f", x AS (SELECT *, {_RET} AS ret FROM bars_gaps) SELECT series, date, {r(4, **_STATS)} FROM x")
def rolling_return_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.rolling_return_stats(views.bars_gaps(spark, sf_dir), **BY), ID, [*_STATS])


@query("rolling_return_stats_many", f", x AS (SELECT *, {_RET} AS ret FROM bars_many) SELECT series, date, {r(4, **_STATS)} FROM x")
def rolling_return_stats_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.rolling_return_stats(views.bars_many(spark, sf_dir), **BY), ID, [*_STATS])


_VZ = {f"volume_zscore_{n}": _full(f"CASE WHEN {over('stddev_samp(v)', n)} > 0 THEN (v - {over('avg(v)', n)}) / {over('stddev_samp(v)', n)} END", "v", n) for n in (21, 63, 252)}


@query("volume_zscore", f", x AS (SELECT *, ln(1 + greatest(volume, 0)) AS v FROM bars) SELECT series, date, {r(**_VZ)} FROM x")
def volume_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.volume_zscore(views.bars(spark, sf_dir), **BY), ID, [*_VZ])


@query("rolling_zscore", f", x AS (SELECT *, {over('avg(volume)', 21)} AS m, {over('stddev_samp(volume)', 21)} AS s FROM bars) SELECT series, date, {r(volume_zscore_21=div('volume - m', 's'))} FROM x")
def rolling_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.rolling_zscore(views.bars(spark, sf_dir), **BY, col="volume", n=21), ID, ["volume_zscore_21"])


_REG = f""", x AS (SELECT b.series, b.date, b.close, {pct('b.close', 'lag(b.close, 21) OVER w')} AS m, {div('b.close', 'o.a_close')} AS q, {pct('b.close', 'lag(b.close) OVER w')} AS d FROM bars b LEFT JOIN bars_wide o ON o.date = b.date WINDOW w AS (PARTITION BY b.series ORDER BY b.date)),
y AS (SELECT *, {pct('q', f'lag(q, 21) OVER ({_W})')} AS s, {over('stddev_samp(d)', 21)} AS v FROM x)"""


@query("regime_bins", _REG + """ SELECT series, date, CASE WHEN m IS NULL THEN NULL WHEN m <= -5 THEN 'strong_down' WHEN m <= -1 THEN 'down' WHEN m <= 1 THEN 'flat' WHEN m <= 5 THEN 'up' ELSE 'strong_up' END AS momentum_regime,
CASE WHEN v IS NULL THEN NULL WHEN v <= 50 THEN 'calm' WHEN v <= 90 THEN 'normal' ELSE 'stressed' END AS volatility_regime, CASE WHEN s IS NULL THEN NULL WHEN s <= -2 THEN 'weaker' WHEN s <= 2 THEN 'neutral' ELSE 'stronger' END AS strength_regime FROM y""")
def regime_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = views.bars(spark, sf_dir)
    df = b.join(b.where("series = 'A'").select("date", F.col("close").alias("other")), "date", "left")
    return op.regime_bins(df, **BY, price="close", other="other").select(*ID, "momentum_regime", "volatility_regime", "strength_regime")


_CP = """, x AS (SELECT series, date, row_number() OVER (PARTITION BY series, date_trunc('month', date) ORDER BY date) AS day_in_month, row_number() OVER (PARTITION BY series, date_trunc('month', date) ORDER BY date DESC) - 1 AS days_left_month,
row_number() OVER (PARTITION BY series, date_trunc('year', date) ORDER BY date) AS day_in_year, row_number() OVER (PARTITION BY series, date_trunc('year', date) ORDER BY date DESC) - 1 AS days_left_year FROM bars)"""


@query("calendar_position", _CP + " SELECT series, date, CAST(day_in_month AS INTEGER) AS day_in_month, CAST(days_left_month AS INTEGER) AS days_left_month, CAST(day_in_year AS INTEGER) AS day_in_year, CAST(days_left_year AS INTEGER) AS days_left_year, CASE WHEN days_left_year < 10 THEN 'year_end' WHEN days_left_month < 5 THEN 'month_end' WHEN day_in_month <= 5 THEN 'month_start' ELSE 'middle' END AS calendar_event FROM x")
def calendar_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.calendar_position(views.bars(spark, sf_dir), **BY).select(*ID, "day_in_month", "days_left_month", "day_in_year", "days_left_year", "calendar_event")


_H = range(1, 11)


@query("target_labels", f"SELECT series, date, {', '.join(f'lead(open, {h}) OVER ({_W}) AS next_{h}_open' for h in _H)} FROM bars_gaps WHERE open IS NOT NULL AND close IS NOT NULL")
def target_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.target_labels(views.bars_gaps(spark, sf_dir), **BY).select(*ID, *(f"next_{h}_open" for h in _H))


@query("label_change_pct", f", x AS (SELECT *, {', '.join(f'lead(open, {h}) OVER ({_W}) AS n{h}' for h in _H)} FROM bars_gaps WHERE open IS NOT NULL AND close IS NOT NULL) SELECT series, date, {r(**{f'change_{h}': pct(f'n{h}', 'close') for h in _H})} FROM x")
def label_change_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.label_change_pct(op.target_labels(views.bars_gaps(spark, sf_dir), **BY)), ID, [f"change_{h}" for h in _H])


_PTD = {f"{n}_return": pct("close", f"first_value(close) OVER (PARTITION BY series, date_trunc('{u}', date) ORDER BY date)") for n, u in (("mtd", "month"), ("qtd", "quarter"), ("ytd", "year"))}


@query("period_to_date", f"SELECT series, date, {r(**_PTD)} FROM bars")
def period_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.period_to_date(views.bars(spark, sf_dir), **BY), ID, [*_PTD])


@query("ffill_causal", f"SELECT series, date, {', '.join(f'last_value({c} IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS {c}' for c in ('open', 'close', 'volume'))} FROM bars_gaps")
def ffill_causal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.ffill_causal(views.bars_gaps(spark, sf_dir), **BY, cols=["open", "close", "volume"]).select(*ID, "open", "close", "volume")
