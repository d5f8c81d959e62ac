"""Queries of the joins and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import indicators, projections
from ..operators import joins as op
from . import views
from .indicators import BY, ID, over
from .projections import div, pct
from .registry import query, r, shown


@query("full_outer_priority", f"SELECT date, {r(price='coalesce(b.close, f.price)')}, b.volume FROM (SELECT * FROM bars WHERE series = 'A') b FULL JOIN fallback_price f USING (date)")
def full_outer_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = views.bars(spark, sf_dir).where("series = 'A'").select("date", F.col("close").alias("price"), "volume")
    return shown(op.full_outer_priority(a, views.fallback_price(spark, sf_dir), on=["date"], cols={"price": "price"}), ["date", "volume"], ["price"])


@query("tail_fill_anti", f"SELECT date, {r(value='value')} FROM (SELECT * FROM primary_spot UNION ALL SELECT * FROM fallback_spot f WHERE NOT EXISTS (SELECT 1 FROM primary_spot p WHERE p.date = f.date)) x")
def tail_fill_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.tail_fill_anti(views.spot(spark, sf_dir, "1-URGENT"), views.spot(spark, sf_dir, "2-HIGH"), on=["date"]), ["date"], ["value"])


_SF = "SELECT date, series_id, value FROM macro_daily WHERE series_id IN ('1-URGENT', '2-HIGH')"


@query("series_fallback", f", p AS ({_SF}) SELECT date, series_id, {r(value='value')} FROM (SELECT * FROM p UNION ALL SELECT date, series_id, value FROM macro_monthly m WHERE series_id NOT IN (SELECT series_id FROM p)) x")
def series_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.macro_daily(spark, sf_dir).where(F.col("series_id").isin("1-URGENT", "2-HIGH"))
    return shown(op.series_fallback(p, views.macro_monthly(spark, sf_dir), series="series_id"), ["date", "series_id"], ["value"])


@query("semi_outliers", f", z AS (SELECT series, date, close, {over('avg(close)', 252)} AS m, {over('stddev_samp(close)', 252)} AS s FROM bars) SELECT series, date, close FROM bars WHERE (series, date) IN (SELECT (series, date) FROM z WHERE s > 0 AND abs(close - m) / s > 1.5)")
def semi_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = views.bars(spark, sf_dir)
    z = projections.rolling_zscore(b, **BY, col="close", n=252).where("abs(close_zscore_252) > 1.5").select(*ID)
    return b.join(z, ID, "left_semi").select(*ID, "close")


#: The series of macro values.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_ASOF = "(SELECT date, series_id, value FROM macro_daily)"


@query("asof_strict", f", l AS (SELECT b.date, s.series_id, b.close FROM (SELECT date, close FROM bars WHERE series = 'A') b CROSS JOIN (SELECT DISTINCT series_id FROM macro_daily) s) SELECT l.date, l.series_id, l.close, {r(value='m.value')} FROM l ASOF LEFT JOIN {_ASOF} m ON l.series_id = m.series_id AND l.date > m.date")
def asof_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = views.macro_daily(spark, sf_dir)
    days = views.bars(spark, sf_dir).where("series = 'A'").select("date", "close")
    left = days.withColumn("series_id", F.explode(F.array(*map(F.lit, PRIORITIES))))
    return shown(op.asof(left, m, keys=["series_id"], left_time="date", right_time="date", cols=["value"]), ["date", "series_id", "close"], ["value"])


@query("asof_strict_many", f" SELECT l.series, l.date, l.close, {r(value='m.close')} FROM bars_many l ASOF LEFT JOIN (SELECT series + 1 AS series, date, close FROM bars_many) m ON l.series = m.series AND l.date > m.date")
def asof_strict_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each series with the last earlier close of the series before it."""
    b = views.bars_many(spark, sf_dir)
    other = b.select((F.col("series") + 1).alias("series"), "date", F.col("close").alias("value"))
    return shown(op.asof(b.select("series", "date", "close"), other, keys=["series"], left_time="date", right_time="date", cols=["value"]), ["series", "date", "close"], ["value"])


_FB = ", ".join(f"CASE WHEN {c} IS NULL AND close IS NOT NULL THEN last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY date RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) ELSE {c} END AS {c}" for c in ("open", "high", "low", "volume"))


@query("ffill_bounded", f"SELECT series, date, close, {_FB} FROM bars_gaps")
def ffill_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["open", "high", "low", "volume"]
    return op.ffill_bounded(views.bars_gaps(spark, sf_dir), **BY, cols=cols, max_gap_days=3, when=F.col("close").isNotNull()).select(*ID, "close", *cols)


@query("interval_join", """, i AS (SELECT contract, report_date, available_date, open_interest, lead(available_date) OVER (PARTITION BY contract ORDER BY available_date) AS next FROM positioning),
l AS (SELECT b.date, c.contract, b.close FROM (SELECT date, close FROM bars WHERE series = 'A') b CROSS JOIN (SELECT DISTINCT contract FROM positioning) c)
SELECT l.date, l.contract, l.close, i.report_date, i.open_interest FROM l LEFT JOIN i ON l.contract = i.contract AND l.date >= i.available_date AND (i.next IS NULL OR l.date < i.next)""")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.positioning(spark, sf_dir)
    days = views.bars(spark, sf_dir).where("series = 'A'").select("date", "close")
    left = days.withColumn("contract", F.explode(F.array(F.lit("F"), F.lit("O"))))  # the two line states
    return op.interval_join(left, p, keys=["contract"], time="date", start="available_date", cols=["report_date", "open_interest"]).select("date", "contract", "close", "report_date", "open_interest")


@query("monthly_to_daily", f"SELECT CAST(unnest(generate_series(date, last_day(date), INTERVAL 1 DAY)) AS DATE) AS date, series_id, {r(value='value')} FROM macro_monthly")
def monthly_to_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.monthly_to_daily(views.macro_monthly(spark, sf_dir), time="date"), ["date", "series_id"], ["value"])


NAMES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


@query("pivot_monthly", f"SELECT date, {r(**{c: f'max(CASE WHEN series_id = {k!r} THEN value END)' for k, c in NAMES.items()})} FROM macro_monthly GROUP BY date")
def pivot_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.pivot_series(views.macro_monthly(spark, sf_dir), time="date", name="series_id", value="value", names=NAMES), ["date"], [*NAMES.values()])


@query("cross_series_pivot_join", f"SELECT b.series, b.date, b.close, w.n_close, w.r_volume, {r(ratio=div('b.close', 'w.n_close'))} FROM bars b LEFT JOIN bars_wide w ON b.date = w.date")
def cross_series_pivot_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.bars(spark, sf_dir).select(*ID, "close").join(views.bars_wide(spark, sf_dir).select("date", "n_close", "r_volume"), "date", "left")
    return shown(df.withColumn("ratio", F.when(F.col("n_close") > 0, F.col("close") / F.col("n_close"))), [*ID, "close", "n_close", "r_volume"], ["ratio"])


_UP = "SELECT date, series_id, value FROM macro_daily WHERE month(date) <= 6"
_NEW = "SELECT date, series_id, CASE WHEN day(date) % 5 <> 0 THEN value + 1 END AS value FROM macro_daily WHERE month(date) >= 6"


def _base_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = views.macro_daily(spark, sf_dir).select("date", "series_id", "value")
    return m.where(F.month("date") <= 6), m.where(F.month("date") >= 6).withColumn("value", F.when(F.dayofmonth("date") % 5 != 0, F.col("value") + 1))


@query("upsert_full", f", a AS ({_UP}), b AS ({_NEW}) SELECT date, series_id, {r(value='value')} FROM (SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.date = a.date AND b.series_id = a.series_id)) x")
def upsert_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _base_new(spark, sf_dir)
    return shown(op.upsert_full(a, b, on=["date", "series_id"]), ["date", "series_id"], ["value"])


@query("upsert_subset", f", a AS (SELECT *, 'base' AS note FROM ({_UP})), b AS ({_NEW}) SELECT date, series_id, {r(value='CASE WHEN b.date IS NOT NULL THEN b.value ELSE a.value END')}, a.note FROM a FULL JOIN b USING (date, series_id)")
def upsert_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _base_new(spark, sf_dir)
    return shown(op.upsert_subset(a.withColumn("note", F.lit("base")), b, on=["date", "series_id"], cols=["value"]), ["date", "series_id", "note"], ["value"])


@query("upsert_ignore", f", a AS ({_UP}), b AS ({_NEW}) SELECT date, series_id, {r(value='value')} FROM (SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.date = a.date AND b.series_id = a.series_id)) x")
def upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _base_new(spark, sf_dir)
    return shown(op.upsert_ignore(a, b, on=["date", "series_id"]), ["date", "series_id"], ["value"])


@query("dedupe_latest", f"SELECT date, series_id, arrival, {r(value='value')} FROM dup_series QUALIFY row_number() OVER (PARTITION BY date, series_id ORDER BY arrival DESC) = 1")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(op.dedupe_latest(views.dup_series(spark, sf_dir), on=["date", "series_id"], order=[F.desc("arrival")]), ["date", "series_id", "arrival"], ["value"])


@query("union_latest_wins", f", f AS (SELECT *, 1 AS source FROM positioning WHERE month(report_date) <= 8 UNION ALL SELECT * REPLACE (open_interest + 1 AS open_interest), 2 AS source FROM positioning WHERE month(report_date) >= 6) SELECT contract, report_date, available_date, source, open_interest FROM f QUALIFY row_number() OVER (PARTITION BY contract, report_date ORDER BY source DESC) = 1 AND report_date >= DATE '1995-06-01' AND available_date <= DATE '2001-06-30'")
def union_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.positioning(spark, sf_dir)
    both = p.where(F.month("report_date") <= 8).withColumn("source", F.lit(1)).unionByName(p.where(F.month("report_date") >= 6).withColumn("open_interest", F.col("open_interest") + 1).withColumn("source", F.lit(2)))
    df = op.dedupe_latest(both, on=["contract", "report_date"], order=[F.desc("source")])
    return df.where("report_date >= date'1995-06-01' and available_date <= date'2001-06-30'").select("contract", "report_date", "available_date", "source", "open_interest")


_W = "PARTITION BY series ORDER BY date"


@query("features_with_labels", f", l AS (SELECT series, date, {', '.join(f'lead(open, {h}) OVER ({_W}) AS next_{h}_open' for h in (1, 5))} FROM bars_gaps WHERE open IS NOT NULL AND close IS NOT NULL), f AS (SELECT series, date, {over('avg(close)', 20)} AS sma_20 FROM bars_gaps) SELECT series, date, {r(6, sma_20='sma_20')}, next_1_open, next_5_open FROM f JOIN l USING (series, date)")
def features_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = views.bars_gaps(spark, sf_dir)
    labels = projections.target_labels(b, **BY, horizons=5).select(*ID, "next_1_open", "next_5_open")
    return shown(indicators.sma_features(b, **BY, spans=[20]).select(*ID, "sma_20").join(labels, ID), [*ID, "next_1_open", "next_5_open"], ["sma_20"], 6)


_DRIVERS = f""", w AS (SELECT * FROM bars_wide WHERE a_close IS NOT NULL),
i AS (SELECT available_date, {div('100 * (longs - shorts)', 'open_interest')} AS net_pct, lead(available_date) OVER (ORDER BY available_date) AS next FROM positioning WHERE contract = 'O'),
x AS (SELECT w.date, {pct('n_close', 'lag(n_close, 5) OVER (ORDER BY w.date)')} AS n_return_5, r_close - lag(r_close, 5) OVER (ORDER BY w.date) AS r_change_5, {pct('a_open', 'lag(a_close) OVER (ORDER BY w.date)')} AS gap, m.value AS macro FROM w ASOF LEFT JOIN (SELECT * FROM macro_daily WHERE series_id = '1-URGENT') m ON w.date >= m.date + 1)"""


@query("market_drivers", _DRIVERS + f" SELECT x.date, {r(n_return_5='n_return_5', r_change_5='r_change_5', gap_pct='gap', macro='macro', net_pct_oi='net_pct')} FROM x LEFT JOIN i ON x.date >= i.available_date AND (i.next IS NULL OR x.date < i.next)")
def market_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-series returns, the gap, the macro value known the day after and the positioning report in force."""
    w = views.bars_wide(spark, sf_dir).where("a_close is not null").withColumn("k", F.lit("A"))
    by = {"keys": ["k"], "time": "date"}
    df = projections.pct_change_k(projections.pct_change_k(w, **by, col="n_close", steps=[5]), **by, col="r_close", steps=[5])
    df = df.withColumns({"open": F.col("a_open"), "high": F.col("a_high"), "low": F.col("a_low"), "close": F.col("a_close")})
    df = projections.bar_shape(df, **by)
    macro = views.spot(spark, sf_dir, "1-URGENT").select(F.lit("A").alias("k"), F.date_add("date", 1).alias("known"), F.col("value").alias("macro"))
    df = op.asof(df, macro, keys=["k"], left_time="date", right_time="known", cols=["macro"], strict=False)
    pos = projections.positioning_features(views.positioning(spark, sf_dir).where("contract = 'O'"), keys=["contract"], time="report_date").select(F.lit("A").alias("k"), "available_date", "net_pct_oi")
    df = op.interval_join(df, pos, keys=["k"], time="date", start="available_date", cols=["net_pct_oi"])
    return shown(df.select("date", F.col("n_close_change_5").alias("n_return_5"), F.col("r_close_diff_5").alias("r_change_5"), "gap_pct", "macro", "net_pct_oi"), ["date"], ["n_return_5", "r_change_5", "gap_pct", "macro", "net_pct_oi"])


_MASTER = f""", o AS (SELECT series, date, close, coalesce(abs(close - {over('avg(close)', 252)}) / nullif({over('stddev_samp(close)', 252)}, 0) > 5, FALSE) AS is_outlier FROM bars_gaps WHERE close IS NOT NULL),
f1 AS (SELECT series, date, {over('avg(close)', 20)} AS sma_20 FROM bars_gaps WHERE close IS NOT NULL), f2 AS (SELECT series, date, {pct('close', 'lag(close, 5) OVER (' + _W + ')')} AS change_5 FROM bars_gaps WHERE close IS NOT NULL), f3 AS (SELECT series, date, month(date) AS month FROM bars_gaps)"""


@query("master_join", _MASTER + f" SELECT series, date, close, {r(6, sma_20='sma_20')}, {r(change_5='change_5')}, CAST(f3.month AS INTEGER) AS month FROM o LEFT JOIN f1 USING (series, date) LEFT JOIN f2 USING (series, date) LEFT JOIN f3 USING (series, date) WHERE NOT is_outlier")
def master_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature groups by key and day beside the cleaned rows; flagged rows feed the windows and go at the end. The groups share one partitioning."""
    from ..operators import quality

    b = views.bars_gaps(spark, sf_dir).where("close is not null")
    base = quality.outlier_flag(b, **BY, col="close", n=252, limit=5.0).select(*ID, "close", "is_outlier")
    groups = [indicators.sma_features(b, **BY, spans=[20]).select(*ID, "sma_20"), projections.pct_change_k(b, **BY, col="close", steps=[5]).select(*ID, F.col("close_change_5").alias("change_5")), projections.calendar_parts(b, time="date").select(*ID, "month")]
    for g in groups:
        base = base.join(g, ID, "left")
    df = base.where("not is_outlier")
    return shown(shown(df, [*ID, "close", "change_5", "month"], ["sma_20"], 6), [*ID, "close", "month", "sma_20"], ["change_5"])
