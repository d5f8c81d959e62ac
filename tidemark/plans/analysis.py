"""Queries of the analysis and data-quality operators."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analogs, projections, quality
from ..operators import analysis as op
from . import views
from .indicators import BY, ID, over
from .projections import _CP, _RET, _STATS, pct
from .registry import query, r, shown

_W = "PARTITION BY series ORDER BY date"
_D1 = pct("close", f"lag(close) OVER ({_W})")
_F5 = pct("lead(close, 5) OVER (" + _W + ")", "close")


def _changes(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Bars with their daily change and the change 5 rows ahead."""
    b = views.bars_gaps(spark, sf_dir) if gaps else views.bars(spark, sf_dir)
    return analogs.future_returns(projections.pct_change_k(b, **BY, col="close", steps=[1]), **BY, horizons=(5,)).withColumnRenamed("close_change_1", "change")


@query("outlier_flag", f", z AS (SELECT *, {over('avg(volume)', 252)} AS m, {over('stddev_samp(volume)', 252)} AS s FROM bars_gaps) SELECT series, date, volume, coalesce(s > 0 AND abs(volume - m) / s > 3, FALSE) AS is_outlier FROM z")
def outlier_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.outlier_flag(views.bars_gaps(spark, sf_dir), **BY, col="volume", limit=3.0).select(*ID, "volume", "is_outlier")


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, {m} AS minimum FROM {t}" for t, m in (("bars", 1000), ("macro_daily", 1000), ("macro_monthly", 100000)))


@query("refresh_gate", f" SELECT name, rows, CAST(minimum AS INTEGER) AS minimum, rows >= minimum AS ok FROM ({_COUNTS}) x")
def refresh_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"bars": (views.bars, 1000), "macro_daily": (views.macro_daily, 1000), "macro_monthly": (views.macro_monthly, 100000)}
    parts = [f(spark, sf_dir).agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows", F.lit(m).alias("minimum")) for n, (f, m) in tables.items()]
    return quality.refresh_gate(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("constraint_report", """ SELECT 'unique' AS rule, count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x
UNION ALL SELECT 'parent', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')
UNION ALL SELECT 'domain_l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem""")
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, orders = views.table(spark, sf_dir, "lineitem"), views.table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    return quality.constraint_report(li, on=["l_orderkey", "l_linenumber"], parent=orders, parent_key="o_orderkey", child_key="l_orderkey", domain={"l_returnflag": ["A", "N"]})


@query("freshness_report", """ SELECT name, last_date, CAST(DATE '2001-11-10' - last_date AS INTEGER) AS age_days, CASE WHEN name = 'gone' THEN 'error' WHEN last_date IS NULL THEN 'empty' WHEN name IN ('spot', 'unread') THEN 'fallback' WHEN DATE '2001-11-10' - last_date > 30 THEN 'stale' ELSE 'ok' END AS status
FROM (SELECT 'bars' AS name, max(date) AS last_date FROM bars UNION ALL SELECT 'macro', max(date) FROM macro_daily UNION ALL SELECT 'none', max(date) FROM bars WHERE volume < 0 UNION ALL SELECT 'gone', NULL
UNION ALL SELECT 'spot', max(date) FROM fallback_spot UNION ALL SELECT 'unread', max(date) FROM fallback_spot) x""")
def freshness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, spot = views.bars(spark, sf_dir), (views.spot(spark, sf_dir, "2-HIGH"), "date")
    tables = {"bars": (b, "date"), "macro": (views.macro_daily(spark, sf_dir), "date"), "none": (b.where("volume < 0"), "date"), "gone": (None, "date"), "spot": (b.where("volume < 0"), "date"), "unread": (None, "date")}
    return quality.freshness_report(tables, as_of="2001-11-10", limit_days=30, fallback={"spot": spot, "unread": spot})


@query("table_status", " SELECT 'orders' AS name, count(*) AS n, 'OK' AS status FROM orders UNION ALL SELECT 'none', count(*), 'EMPTY' FROM orders WHERE o_totalprice < 0 UNION ALL SELECT 'gone', -1, 'NOT FOUND'")
def table_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = views.table(spark, sf_dir, "orders")
    return quality.table_status({"orders": o, "none": o.where("o_totalprice < 0"), "gone": None})


_COLS = ["open", "high", "low", "close", "volume"]


@query("missing_profile", " SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, round(100.0 * (count(*) - count({c})) / count(*), 2) AS percent FROM bars_gaps" for c in ["date", *_COLS]) + ") x WHERE missing > 0")
def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = views.bars_gaps(spark, sf_dir)
    return quality.missing_profile(b.withColumn("date", F.col("date").cast("string")), cols=["date", *_COLS])


@query("feature_coverage", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {r(6, coverage=f'count({c}) / count(*)')}, count({c}) / count(*) >= 0.9 AS selected FROM bars_gaps" for c in _COLS))
def feature_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(quality.feature_coverage(views.bars_gaps(spark, sf_dir), cols=_COLS, least=0.9), ["column", "selected"], ["coverage"], 6)


_GS = f", x AS (SELECT series, date, {_D1} AS change, {_F5} AS future_5 FROM bars), g AS (SELECT series, month(date) AS month, future_5 AS v FROM x WHERE future_5 IS NOT NULL)"
_GSUM = "count(*) AS n, " + r(mean="avg(v)", median="median(v)", sd="stddev_samp(v)", up_rate="avg(CASE WHEN v > 0 THEN 1.0 ELSE 0.0 END)", t_stat="CASE WHEN stddev_samp(v) > 0 THEN avg(v) / (stddev_samp(v) / sqrt(count(*))) END")


@query("group_summary", _GS + f" SELECT 'month' AS kind, CAST(month AS VARCHAR) AS level, {_GSUM} FROM g GROUP BY month UNION ALL SELECT 'series', series, {_GSUM} FROM g GROUP BY series")
def group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _changes(spark, sf_dir).withColumn("month", F.month("date").cast("string"))
    parts = [op.group_summary(df, by=[c], value="future_5").select(F.lit(c).alias("kind"), F.col(c).alias("level"), "n", "mean", "median", "sd", "up_rate", "t_stat") for c in ("month", "series")]
    return shown(parts[0].unionByName(parts[1]), ["kind", "level", "n"], ["mean", "median", "sd", "up_rate", "t_stat"])


@query("top_abs_tstat", _GS + f", s AS (SELECT series, month, avg(v) / (stddev_samp(v) / sqrt(count(*))) AS t FROM g GROUP BY 1, 2) SELECT series, CAST(month AS INTEGER) AS month, {r(t_stat='t')} FROM s WHERE t IS NOT NULL ORDER BY abs(t) DESC, series, month LIMIT 20")
def top_abs_tstat(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = op.group_summary(_changes(spark, sf_dir).withColumn("month", F.month("date")), by=["series", "month"], value="future_5")
    return shown(op.top_abs(g, col="t_stat", k=20, ties=["series", "month"]), ["series", "month"], ["t_stat"])


@query("seasonal_consistency", f", x AS (SELECT series, date, {_D1} AS v FROM bars), y AS (SELECT series, year(date) AS y, month(date) AS month, avg(v) AS m FROM x WHERE v IS NOT NULL GROUP BY 1, 2, 3) SELECT series, CAST(month AS INTEGER) AS month, count(*) AS years, {r(mean='avg(m)', median='median(m)', positive_rate='avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END)')} FROM y GROUP BY 1, 2")
def seasonal_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.seasonal_consistency(_changes(spark, sf_dir), **BY, value="change"), ["series", "month", "years"], ["mean", "median", "positive_rate"])


_MOM = {"mean": "avg(v)", "sd": "stddev_samp(v)", "min": "min(v)", "max": "max(v)"}


@query("describe_target", f", x AS (SELECT series, {_F5} AS v FROM bars) SELECT series, count(v) AS n, {r(**_MOM, **{f'p{p}': f'quantile_cont(v, {p / 100})' for p in op.PERCENTS})} FROM x GROUP BY series")
def describe_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.describe(_changes(spark, sf_dir), by=["series"], value="future_5"), ["series", "n"], [*_MOM, *(f"p{p}" for p in op.PERCENTS)])


@query("target_by_year", f", x AS (SELECT series, year(date) AS year, {_F5} AS v FROM bars) SELECT series, CAST(year AS INTEGER) AS year, count(v) AS n, {r(**_MOM, median='median(v)')} FROM x GROUP BY 1, 2")
def target_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.describe(_changes(spark, sf_dir).withColumn("year", F.year("date")), by=["series", "year"], value="future_5")
    return shown(df.withColumnRenamed("p50", "median"), ["series", "year", "n"], [*_MOM, "median"])


_CORR = f", x AS (SELECT open, high, low, close, volume, {_D1} AS change FROM bars_gaps)"
_CC = sorted([*_COLS, "change"])
_PAIRS = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS c FROM x" for a, b in combinations(_CC, 2))


@query("corr_matrix", _CORR + f" SELECT a, b, {r(6, corr='c')} FROM ({_PAIRS}) y")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.corr_matrix(_changes(spark, sf_dir, gaps=True), cols=_CC), ["a", "b"], ["corr"], 6)


@query("redundant_pairs", _CORR + f" SELECT a, b, {r(6, corr='c')} FROM ({_PAIRS}) y WHERE abs(c) >= 0.3")
def redundant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.redundant_pairs(_changes(spark, sf_dir, gaps=True), cols=_CC, least=0.3), ["a", "b"], ["corr"], 6)


_WIDE = sorted([*_STATS, *_COLS])
_WIDE_X = f", y AS (SELECT *, {_RET} AS ret FROM bars_gaps), x AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _STATS.items())}, {', '.join(_COLS)} FROM y)"
_WIDE_PAIRS = [*combinations(_WIDE, 2)]
_WIDE_SQL = f", z AS (SELECT {', '.join(f'corr({a}, {b}) AS c{i}' for i, (a, b) in enumerate(_WIDE_PAIRS))} FROM x), k AS (SELECT unnest([{', '.join(repr(a) for a, _ in _WIDE_PAIRS)}]) AS a, unnest([{', '.join(repr(b) for _, b in _WIDE_PAIRS)}]) AS b, unnest([{', '.join(f'CASE WHEN NOT isnan(c{i}) THEN c{i} END' for i in range(len(_WIDE_PAIRS)))}]) AS c FROM z)"


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with all statistics of their returns: 53 columns, with gaps."""
    return projections.rolling_return_stats(views.bars_gaps(spark, sf_dir), **BY)


@query("corr_matrix_wide", _WIDE_X + _WIDE_SQL + f" SELECT a, b, {r(6, corr='c')} FROM k")
def corr_matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.wide_corr_matrix(_wide(spark, sf_dir), cols=_WIDE), ["a", "b"], ["corr"], 6)


@query("redundant_pairs_wide", _WIDE_X + _WIDE_SQL + f" SELECT a, b, {r(6, corr='c')} FROM k WHERE abs(c) >= 0.98")
def redundant_pairs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.redundant_pairs(_wide(spark, sf_dir), cols=_WIDE), ["a", "b"], ["corr"], 6)


_SP = f""", x AS (SELECT series, open, volume, close, {_F5} AS t FROM bars_gaps), u AS (SELECT series, t, feature, v FROM (""" + " UNION ALL ".join(f"SELECT series, t, '{c}' AS feature, {c} AS v FROM x" for c in ("open", "volume", "close")) + """) z WHERE t IS NOT NULL AND v IS NOT NULL),
k AS (SELECT series, feature, rank() OVER (PARTITION BY series, feature ORDER BY v) + (count(*) OVER (PARTITION BY series, feature, v) - 1) / 2.0 AS a, rank() OVER (PARTITION BY series, feature ORDER BY t) + (count(*) OVER (PARTITION BY series, feature, t) - 1) / 2.0 AS b FROM u)"""


@query("spearman_target", _SP + f" SELECT series, feature, count(*) AS n, {r(6, rho='corr(a, b)')} FROM k GROUP BY 1, 2")
def spearman_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.spearman_target(_changes(spark, sf_dir, gaps=True), keys=["series"], cols=["open", "volume", "close"], target="future_5"), ["series", "feature", "n"], ["rho"], 6)


_DR = f", x AS (SELECT series, close, volume, row_number() OVER ({_W}) > floor(count(*) OVER (PARTITION BY series) * 0.8) AS late FROM bars), u AS (" + " UNION ALL ".join(f"SELECT series, late, '{c}' AS feature, {c} AS v FROM x" for c in ("close", "volume")) + ")"


@query("drift_smd", _DR + f" SELECT series, feature, {r(m0='avg(v) FILTER (WHERE NOT late)', m1='avg(v) FILTER (WHERE late)', drift='abs(avg(v) FILTER (WHERE late) - avg(v) FILTER (WHERE NOT late)) / nullif(stddev_samp(v) FILTER (WHERE NOT late), 0)')} FROM u GROUP BY 1, 2")
def drift_smd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.drift_smd(views.bars(spark, sf_dir), **BY, cols=["close", "volume"]), ["series", "feature"], ["m0", "m1", "drift"])


@query("data_quality_summary", f" SELECT series, count(*) AS rows, count(*) FILTER (WHERE close IS NULL) AS missing, count(*) FILTER (WHERE close > 50000) AS above, count(DISTINCT date) AS dates, min(date) AS first_date, max(date) AS last_date, {r(mean_above='avg(close) FILTER (WHERE close > 50000)')} FROM bars_gaps GROUP BY series")
def data_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = op.data_quality_summary(views.bars_gaps(spark, sf_dir), by=["series"], time="date", value="close")
    return shown(df, ["series", "rows", "missing", "above", "dates", "first_date", "last_date"], ["mean_above"])


@query("return_histogram", f", x AS (SELECT series, {_D1} AS v FROM bars), e AS (SELECT series, min(v) AS lo, max(v) AS hi FROM x GROUP BY 1) SELECT series, CAST(least(floor((v - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n FROM x JOIN e USING (series) WHERE v IS NOT NULL GROUP BY 1, 2")
def return_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.return_histogram(_changes(spark, sf_dir), keys=["series"], value="change")


_HASHED = "concat_ws('|', '+' || CAST(date AS VARCHAR), '+' || CAST(CAST(round(open * 100) AS BIGINT) AS VARCHAR), '+' || CAST(CAST(volume AS BIGINT) AS VARCHAR))"


@query("content_hash", f" SELECT series, CAST(sum(CAST('0x' || substr(md5({_HASHED}), 1, 15) AS HUGEINT)) AS VARCHAR) AS hash, count(*) AS n FROM bars GROUP BY series")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in cents, since the two engines write doubles differently."""
    b = views.bars(spark, sf_dir).select("series", "date", F.round(F.col("open") * 100).cast("long").alias("open"), F.col("volume").cast("long").alias("volume"))
    return op.content_hash(b, by=["series"], cols=["date", "open", "volume"])


@query("latest_row", " SELECT series, date, close, volume FROM bars QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) = 1")
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_row(views.bars(spark, sf_dir), **BY, cols=["close", "volume"])


@query("scan_latest", " SELECT series, date, close FROM bars_gaps WHERE close IS NOT NULL AND date >= DATE '1996-01-01' ORDER BY date DESC, series LIMIT 50")
def scan_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.bars_gaps(spark, sf_dir).where("close is not null and date >= date'1996-01-01'").select(*ID, "close").orderBy(F.desc("date"), "series").limit(50)


@query("latest_analogs")
def latest_analogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = analogs.same_month(analogs.future_returns(views.bars(spark, sf_dir), **BY), **BY)
    return shown(op.latest_values(df, **BY, prefix="month_"), ["series", "date", "name"], ["value"])


from .analogs import _HIST, _SEASON  # noqa: E402
from . import registry  # noqa: E402

registry.ORACLES["latest_analogs"] = views.sql(_HIST + f""", mo AS (SELECT c.series, c.date, {', '.join(f'CAST({e} AS DOUBLE) AS {n}' for n, e in _SEASON.items())} FROM h c LEFT JOIN h ON h.series = c.series AND h.date <= c.date - INTERVAL 1 YEAR AND month(h.date) = month(c.date)
WHERE (c.series, c.date) IN (SELECT (series, max(date)) FROM bars GROUP BY series) GROUP BY c.series, c.date) SELECT series, date, name, {r(value='value')} FROM (""" + " UNION ALL ".join(f"SELECT series, date, '{n}' AS name, {n} AS value FROM mo" for n in _SEASON) + ") x")
