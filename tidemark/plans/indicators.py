"""Queries of the technical indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import indicators as op
from . import views
from .registry import query, r, shown

ID = ["series", "date"]
BY = {"keys": ["series"], "time": "date"}
_W = "PARTITION BY series ORDER BY date"


def over(e: str, n: int) -> str:
    return f"{e} OVER ({_W} ROWS {n - 1} PRECEDING)"


@query("sma_features", f"SELECT series, date, {r(6, **{f'sma_{n}': over('avg(close)', n) for n in op.SPANS})}, {r(4, std_20=over('stddev_samp(close)', 20))} FROM bars")
def sma_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.sma_features(views.bars(spark, sf_dir), **BY)
    return shown(shown(df, [*ID, "std_20"], [f"sma_{n}" for n in op.SPANS], 6), [*ID, *(f"sma_{n}" for n in op.SPANS)], ["std_20"])


@query("sma_features_many", f"SELECT series, date, {r(6, **{f'sma_{n}': over('avg(close)', n) for n in op.SPANS})}, {r(4, std_20=over('stddev_samp(close)', 20))} FROM bars_many")
def sma_features_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over as many series as there are suppliers."""
    df = op.sma_features(views.bars_many(spark, sf_dir), **BY)
    return shown(shown(df, [*ID, "std_20"], [f"sma_{n}" for n in op.SPANS], 6), [*ID, *(f"sma_{n}" for n in op.SPANS)], ["std_20"])


def ema_sql(name: str, table: str, col: str, spans: list[int], prefix: str) -> str:
    """Band self-join on row numbers; nulls drop from both sums."""
    cols = ", ".join(f"sum(CASE WHEN a.rn - b.rn < {n} THEN b.{col} * pow({1 - 2 / (n + 1)!r}, a.rn - b.rn) END) / nullif(sum(CASE WHEN a.rn - b.rn < {n} AND b.{col} IS NOT NULL THEN pow({1 - 2 / (n + 1)!r}, a.rn - b.rn) END), 0) AS {prefix}{n}" for n in spans)
    return f"{name} AS (SELECT a.series, a.date, {cols} FROM {table} a JOIN {table} b ON a.series = b.series AND b.rn BETWEEN a.rn - {max(spans) - 1} AND a.rn GROUP BY 1, 2)"


_RN = f", t AS (SELECT *, row_number() OVER ({_W}) AS rn FROM {{}})"


@query("ema_features", _RN.format("bars") + ", " + ema_sql("e", "t", "close", op.SPANS, "ema_") + f" SELECT series, date, {r(**{f'ema_{n}': f'ema_{n}' for n in op.SPANS})} FROM e")
def ema_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.ema_features(views.bars(spark, sf_dir), **BY), ID, [f"ema_{n}" for n in op.SPANS])


_BB = f", b AS (SELECT series, date, close, {over('avg(close)', 20)} AS m, {over('stddev_samp(close)', 20)} AS s FROM bars)"


@query("bollinger", _BB + " SELECT series, date, " + r(6, bb_middle="m") + ", " + r(4, bb_upper="m + 2 * s", bb_lower="m - 2 * s", bb_width="CASE WHEN m > 0 THEN 4 * s / m END", bb_percent="CASE WHEN s > 0 THEN (close - m + 2 * s) / (4 * s) END") + " FROM b")
def bollinger(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["bb_upper", "bb_lower", "bb_width", "bb_percent"]
    df = op.bollinger(views.bars(spark, sf_dir), **BY)
    return shown(shown(df, [*ID, *cols], ["bb_middle"], 6), [*ID, "bb_middle"], cols)


_RSI = f""", d AS (SELECT series, date, close - lag(close) OVER ({_W}) AS d, row_number() OVER ({_W}) AS rn FROM {{}}),
g AS (SELECT *, {over('avg(greatest(d, 0))', 14)} AS ag, {over('avg(greatest(-d, 0))', 14)} AS al FROM d)"""
_RSI_VALUE = "CASE WHEN rn < 14 THEN NULL WHEN al = 0 THEN 100.0 ELSE 100 - 100 / (1 + ag / al) END"


@query("rsi", _RSI.format("bars_gaps") + f" SELECT series, date, {r(rsi_14=_RSI_VALUE)} FROM g")
def rsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.rsi(views.bars_gaps(spark, sf_dir), **BY), ID, ["rsi_14"])


_MACD = (
    _RN.format("bars") + ", " + ema_sql("e", "t", "close", [12, 26], "e") + f""", m AS (SELECT t.series, t.date, t.rn, CASE WHEN t.rn >= 26 THEN e12 - e26 END AS macd FROM t JOIN e ON t.series = e.series AND t.date = e.date),
k AS (SELECT * FROM m WHERE macd IS NOT NULL), """ + ema_sql("s", "k", "macd", [9], "s")
)


@query("macd", _MACD + f" SELECT m.series, m.date, {r(macd='macd', macd_signal='s9', macd_histogram='macd - s9')} FROM m LEFT JOIN s ON m.series = s.series AND m.date = s.date")
def macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.macd(views.bars(spark, sf_dir), **BY), ID, ["macd", "macd_signal", "macd_histogram"])


_ROC = f"100 * (close - lag(close, 10) OVER ({_W})) / nullif(lag(close, 10) OVER ({_W}), 0)"


@query("roc", f"SELECT series, date, {r(roc_10=_ROC)} FROM bars")
def roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.roc(views.bars(spark, sf_dir), **BY), ID, ["roc_10"])


_CCI = f""", t AS (SELECT *, row_number() OVER ({_W}) AS rn, (high + low + close) / 3 AS tp FROM {{}}),
p AS (SELECT *, avg(tp) OVER ({_W} ROWS 19 PRECEDING) AS sma FROM t WHERE tp IS NOT NULL),
q AS (SELECT p.series, p.date, any_value(p.tp) AS tp, any_value(p.sma) AS sma, avg(abs(b.tp - p.sma)) AS mad FROM p JOIN t b ON p.series = b.series AND b.rn BETWEEN p.rn - 19 AND p.rn GROUP BY 1, 2)"""
_CCI_VALUE = "CASE WHEN mad > 0 THEN (q.tp - sma) / (0.015 * mad) END"


@query("cci", _CCI.format("bars_gaps") + f" SELECT t.series, t.date, {r(3, cci_20=_CCI_VALUE)} FROM t LEFT JOIN q ON t.series = q.series AND t.date = q.date")
def cci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.cci(views.bars_gaps(spark, sf_dir), **BY), ID, ["cci_20"], 3)


_STO = f", a AS (SELECT *, {over('min(low)', 14)} AS lo, {over('max(high)', 14)} AS hi FROM bars), k AS (SELECT series, date, CASE WHEN hi - lo > 0 THEN 100 * (close - lo) / (hi - lo) END AS k FROM a)"


@query("stochastic", _STO + f" SELECT series, date, {r(stoch_k='k', stoch_d=over('avg(k)', 3))} FROM k")
def stochastic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.stochastic(views.bars(spark, sf_dir), **BY), ID, ["stoch_k", "stoch_d"])


_ALL = (
    _MACD + f", d AS (SELECT series, date, close - lag(close) OVER ({_W}) AS d, row_number() OVER ({_W}) AS rn FROM bars), g AS (SELECT *, {over('avg(greatest(d, 0))', 14)} AS ag, {over('avg(greatest(-d, 0))', 14)} AS al FROM d)"
    + _STO.replace(" k AS", " st AS") + _CCI.format("bars").replace(", t AS", ", ct AS").replace("FROM t WHERE", "FROM ct WHERE").replace("JOIN t b", "JOIN ct b")
    + ", x AS (SELECT series, date, k AS stoch_k, " + over("avg(k)", 3) + f" AS stoch_d FROM st), y AS (SELECT series, date, {_ROC} AS roc_10 FROM bars)"
)


@query("momentum_features", _ALL + f" SELECT g.series, g.date, {r(rsi_14=_RSI_VALUE.replace('rn <', 'g.rn <'), macd='macd', macd_signal='s9', macd_histogram='macd - s9', roc_10='roc_10', stoch_k='stoch_k', stoch_d='stoch_d')}, {r(3, cci_20=_CCI_VALUE)} FROM g JOIN m USING (series, date) LEFT JOIN s USING (series, date) LEFT JOIN q USING (series, date) JOIN x USING (series, date) JOIN y USING (series, date)")
def momentum_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.momentum_features(views.bars(spark, sf_dir), **BY)
    cols = ["rsi_14", "macd", "macd_signal", "macd_histogram", "roc_10", "stoch_k", "stoch_d"]
    return shown(shown(df, [*ID, *cols], ["cci_20"], 3), [*ID, "cci_20"], cols)


_ADX = f""", a AS (SELECT *, row_number() OVER ({_W}) AS rn, lag(close) OVER ({_W}) AS pc, high - lag(high) OVER ({_W}) AS up, lag(low) OVER ({_W}) - low AS dn FROM bars_gaps),
b AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS pdm, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS mdm FROM a),
c AS (SELECT *, {over('avg(tr)', 14)} AS atr, {over('avg(pdm)', 14)} AS p, {over('avg(mdm)', 14)} AS m FROM b),
d AS (SELECT series, date, atr, CASE WHEN rn >= 14 AND atr > 0 THEN 100 * p / atr END AS pdi, CASE WHEN rn >= 14 AND atr > 0 THEN 100 * m / atr END AS mdi FROM c),
e AS (SELECT *, CASE WHEN pdi + mdi > 0 THEN 100 * abs(pdi - mdi) / (pdi + mdi) END AS dx FROM d)"""


@query("adx", _ADX + f" SELECT series, date, {r(3, atr_14='atr', plus_di='pdi', minus_di='mdi', dx='dx', adx_14='CASE WHEN dx IS NOT NULL THEN ' + over('avg(dx)', 14) + ' END')} FROM e")
def adx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.adx(views.bars_gaps(spark, sf_dir), **BY), ID, ["atr_14", "plus_di", "minus_di", "dx", "adx_14"], 3)


def _z(n: int) -> str:
    return f"CASE WHEN {over('stddev_samp(close)', n)} > 0 THEN (close - {over('avg(close)', n)}) / {over('stddev_samp(close)', n)} END"


@query("zscore", f"SELECT series, date, {r(zscore_20=_z(20), zscore_60=_z(60))} FROM bars_gaps")
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.zscore(views.bars_gaps(spark, sf_dir), **BY), ID, ["zscore_20", "zscore_60"])


def _change(n: int) -> str:
    return f"CASE WHEN lag(close, {n}) OVER ({_W}) > 0 THEN 100 * (close / lag(close, {n}) OVER ({_W}) - 1) END"


_SLIDE = {f"{a}_{n}": e for n in (5, 21, 63, 252) for a, e in (("avg", over("avg(close)", n)), ("max", over("max(close)", n)), ("min", over("min(close)", n)), ("sd", over("stddev_samp(close)", n)), ("change", _change(n)))} | {f"volume_avg_{n}": over("avg(volume)", n) for n in (5, 21)}


@query("sliding_windows", f"SELECT series, date, {r(3, **_SLIDE)} FROM bars")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.sliding_windows(views.bars(spark, sf_dir), **BY), ID, [*_SLIDE], 3)


_EW = [5, 21, 63, 252]
_EWMA = _RN.format("bars_gaps") + ", " + ema_sql("e", "t", "close", _EW, "ewma_") + ", " + ema_sql("v", "t", "volume", _EW, "volume_ewma_")
_EWMA_COLS = {f"ewma_{n}": f"ewma_{n}" for n in _EW} | {f"volume_ewma_{n}": f"volume_ewma_{n}" for n in _EW} | {f"distance_{n}": f"CASE WHEN ewma_{n} > 0 THEN 100 * (close / ewma_{n} - 1) END" for n in _EW}
_CROSS = [(5, 21), (21, 63), (63, 252)]


@query("ewma_features", _EWMA + f" SELECT series, date, {r(3, **_EWMA_COLS)}, {', '.join(f'CASE WHEN ewma_{a} > ewma_{b} THEN 1 ELSE -1 END AS cross_{a}_{b}' for a, b in _CROSS)} FROM t JOIN e USING (series, date) JOIN v USING (series, date)")
def ewma_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.ewma_features(views.bars_gaps(spark, sf_dir), **BY), [*ID, *(f"cross_{a}_{b}" for a, b in _CROSS)], [*_EWMA_COLS], 3)
