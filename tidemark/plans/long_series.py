"""The window operators, lookups and fills on one long series, the order of all shipments, cut into chunks. Their SQL is that of the queries on many series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analysis, quantiles
from ..operators import long_series as op
from . import indicators, joins, views
from .indicators import _ADX, _CCI, _CCI_VALUE, _EW, _EWMA, _EWMA_COLS, _MACD, _ROC, _RSI, _RSI_VALUE, _SLIDE, _STO, ID, over
from .projections import _RET, _STATS, _VZ
from .registry import query, r, shown

#: Small enough that the series is many chunks at every scale.
ROWS = 4_000
TICK = {"keys": ["series"], "time": "tick", "rows": ROWS}
AT = ["series", "tick"]


def _ticks(body: str) -> str:
    """The SQL of a query on bars, on ticks."""
    return body.replace("bars_many", "ticks").replace("bars", "ticks").replace("date", "tick")


@query("sma_long", _ticks(f"SELECT series, date, {r(6, **{f'sma_{n}': over('avg(close)', n) for n in indicators.op.SPANS})}, {r(4, std_20=over('stddev_samp(close)', 20))} FROM bars"))
def sma_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, names = op.windows(views.ticks(spark, sf_dir), "sma_features", **TICK), [f"sma_{n}" for n in indicators.op.SPANS]
    return shown(shown(df, [*AT, "std_20"], names, 6), [*AT, *names], ["std_20"])


_MOMENTUM = (
    _MACD + f", d AS (SELECT series, date, close - lag(close) OVER (PARTITION BY series ORDER BY date) AS d, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM bars), g AS (SELECT *, {over('avg(greatest(d, 0))', 14)} AS ag, {over('avg(greatest(-d, 0))', 14)} AS al FROM d)"
    + _STO.replace(" k AS", " st AS") + ", x AS (SELECT series, date, k AS stoch_k, " + over("avg(k)", 3) + f" AS stoch_d FROM st), y AS (SELECT series, date, {_ROC} AS roc_10 FROM bars)"
    + f" SELECT g.series, g.date, {r(rsi_14=_RSI_VALUE.replace('rn <', 'g.rn <'), macd='macd', macd_signal='s9', macd_histogram='macd - s9', roc_10='roc_10', stoch_k='stoch_k', stoch_d='stoch_d')} FROM g JOIN m USING (series, date) LEFT JOIN s USING (series, date) JOIN x USING (series, date) JOIN y USING (series, date)"
)


@query("momentum_long", _ticks(_MOMENTUM))
def momentum_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSI, MACD, rate of change and stochastic of one cut: the halo is the deepest of the four."""

    def all_of(df: DataFrame, *, keys: list[str], time: str) -> DataFrame:
        for f in (indicators.op.rsi, indicators.op.roc, indicators.op.stochastic, indicators.op.macd):
            df = f(df, keys=keys, time=time)
        return df

    df = op.in_chunks(views.ticks(spark, sf_dir), all_of, **TICK, before=max(op.REACH[n] for n in ("rsi", "macd", "roc", "stochastic")))
    return shown(df, AT, ["rsi_14", "macd", "macd_signal", "macd_histogram", "roc_10", "stoch_k", "stoch_d"])


@query("rsi_long", _ticks(_RSI.format("bars_gaps") + f" SELECT series, date, {r(rsi_14=_RSI_VALUE)} FROM g"))
def rsi_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.windows(views.ticks_gaps(spark, sf_dir), "rsi", **TICK), AT, ["rsi_14"])


@query("cci_long", _ticks(_CCI.format("bars_gaps") + f" SELECT t.series, t.date, {r(3, cci_20=_CCI_VALUE)} FROM t LEFT JOIN q ON t.series = q.series AND t.date = q.date"))
def cci_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.cci(views.ticks_gaps(spark, sf_dir), **TICK), AT, ["cci_20"], 3)


@query("adx_long", _ticks(_ADX + f" SELECT series, date, {r(3, atr_14='atr', plus_di='pdi', minus_di='mdi', dx='dx', adx_14='CASE WHEN dx IS NOT NULL THEN ' + over('avg(dx)', 14) + ' END')} FROM e"))
def adx_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.windows(views.ticks_gaps(spark, sf_dir), "adx", **TICK), AT, ["atr_14", "plus_di", "minus_di", "dx", "adx_14"], 3)


@query("zscore_long", _ticks(f"SELECT series, date, {r(zscore_20=indicators._z(20), zscore_60=indicators._z(60))} FROM bars_gaps"))
def zscore_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.windows(views.ticks_gaps(spark, sf_dir).select(*AT, "close"), "zscore", **TICK), AT, ["zscore_20", "zscore_60"])


@query("sliding_long", _ticks(f"SELECT series, date, {r(3, **_SLIDE)} FROM bars"))
def sliding_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.windows(views.ticks(spark, sf_dir), "sliding_windows", **TICK), AT, [*_SLIDE], 3)


@query("ewma_long", _ticks(_EWMA + f" SELECT series, date, {r(3, **_EWMA_COLS)} FROM t JOIN e USING (series, date) JOIN v USING (series, date)"))
def ewma_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.windows(views.ticks_gaps(spark, sf_dir), "ewma_features", **TICK), AT, [*_EWMA_COLS], 3)


@query("rolling_return_stats_long", _ticks(f", x AS (SELECT *, {_RET} AS ret FROM bars_gaps) SELECT series, date, {r(4, **_STATS)} FROM x"))
def rolling_return_stats_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.windows(views.ticks_gaps(spark, sf_dir), "rolling_return_stats", **TICK), AT, [*_STATS])


@query("volume_zscore_long", _ticks(f", x AS (SELECT *, ln(1 + greatest(volume, 0)) AS v FROM bars) SELECT series, date, {r(**_VZ)} FROM x"))
def volume_zscore_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.windows(views.ticks(spark, sf_dir), "volume_zscore", **TICK), AT, [*_VZ])


@query("target_labels_long", _ticks(f"SELECT series, date, {', '.join(f'lead(open, {h}) OVER (PARTITION BY series ORDER BY date) AS next_{h}_open' for h in range(1, 11))} FROM bars_gaps WHERE open IS NOT NULL AND close IS NOT NULL"))
def target_labels_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.target_labels(views.ticks_gaps(spark, sf_dir), **TICK).select(*AT, *(f"next_{h}_open" for h in range(1, 11)))


@query("ffill_long", _ticks(f"SELECT series, date, {', '.join(f'last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS UNBOUNDED PRECEDING) AS {c}' for c in ('open', 'close', 'volume'))} FROM bars_gaps"))
def ffill_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.ffill_causal(views.ticks_gaps(spark, sf_dir), **TICK, cols=["open", "close", "volume"]).select(*AT, "open", "close", "volume")


@query("ffill_bounded_long", f"SELECT series, date, close, {joins._FB} FROM bars_gaps")
def ffill_bounded_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series, each cut into several ranges: a fill looks back by days."""
    cols = ["open", "high", "low", "volume"]
    return op.ffill_bounded(views.bars_gaps(spark, sf_dir), keys=["series"], time="date", cols=cols, max_gap_days=3, when=F.col("close").isNotNull(), rows=500).select(*ID, "close", *cols)


_BIG = "(SELECT series, tick, close AS known, volume AS size FROM ticks WHERE volume > 45)"


def _big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger shipments, as reports that later rows look up."""
    return views.ticks(spark, sf_dir).where("volume > 45").select("series", F.col("tick").alias("since"), F.col("close").alias("known"), F.col("volume").alias("size"))


@query("asof_long", f" SELECT l.series, l.tick, l.close, {r(known='m.known')}, m.size FROM ticks l ASOF LEFT JOIN {_BIG} m ON l.series = m.series AND l.tick > m.tick")
def asof_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.asof(views.ticks(spark, sf_dir).select(*AT, "close"), _big(spark, sf_dir), keys=["series"], left_time="tick", right_time="since", cols=["known", "size"], rows=ROWS)
    return shown(df, [*AT, "close", "size"], ["known"])


@query("interval_long", f" SELECT l.series, l.tick, l.close, m.tick AS since, m.size FROM ticks l ASOF LEFT JOIN {_BIG} m ON l.series = m.series AND l.tick >= m.tick")
def interval_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = _big(spark, sf_dir).withColumn("start", F.col("since"))
    return op.interval_join(views.ticks(spark, sf_dir).select(*AT, "close"), right, keys=["series"], time="tick", start="start", cols=["since", "size"], rows=ROWS)




_SHARES = (1, 5, 25, 50, 75, 95, 99)


@query("quantiles_long", f" SELECT size, {r(**{f'p{p}': f'quantile_cont(change, {p / 100})' for p in _SHARES})} FROM (SELECT CASE WHEN volume > 45 THEN 'large' ELSE 'small' END AS size, close - open AS change FROM ticks_gaps) x GROUP BY size")
def quantiles_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two groups, both larger than one task may order; many changes are 0."""
    df = views.ticks_gaps(spark, sf_dir).select(F.when(F.col("volume") > 45, "large").otherwise("small").alias("size"), (F.col("close") - F.col("open")).alias("change"))
    names = [f"p{p}" for p in _SHARES]
    return shown(quantiles.quantiles(df, by=["size"], value="change", shares=[p / 100 for p in _SHARES], out=names, large=2_000, few=500), ["size"], names)


_PAIRS = " UNION ALL ".join(f"SELECT series, '{c}' AS feature, {c} AS v, t FROM x" for c in ("volume", "high"))


@query("spearman_long", f""", x AS (SELECT series, volume, high, close - open AS t FROM ticks_gaps), u AS (SELECT * FROM ({_PAIRS}) z WHERE t IS NOT NULL AND v IS NOT NULL),
k AS (SELECT series, feature, rank() OVER (PARTITION BY series, feature ORDER BY v) + (count(*) OVER (PARTITION BY series, feature, v) - 1) / 2.0 AS a, rank() OVER (PARTITION BY series, feature ORDER BY t) + (count(*) OVER (PARTITION BY series, feature, t) - 1) / 2.0 AS b FROM u)
SELECT series, feature, count(*) AS n, {r(6, rho='corr(a, b)')} FROM k GROUP BY 1, 2""")
def spearman_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against values with thousands of ties, ranked by ranges."""
    df = views.ticks_gaps(spark, sf_dir).withColumn("t", F.col("close") - F.col("open"))
    return shown(analysis.spearman_target(df, keys=["series"], cols=["volume", "high"], target="t", rows=ROWS), ["series", "feature", "n"], ["rho"], 6)
