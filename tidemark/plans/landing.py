"""Queries of the landing jobs: the given tables are rendered as a source would send them, and normalised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import landing as op
from . import views
from .registry import query, r, shown


@query("norm_ohlcv", "SELECT date, series AS ticker, open, close, volume, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low FROM bars_gaps WHERE close IS NOT NULL")
def norm_ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = views.bars_gaps(spark, sf_dir)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("n/a"))
    raw = b.select(F.concat(F.col("date").cast("string"), F.lit("T00:00")).alias(" Date"), F.col("series").alias("Ticker"), text("open").alias("Open "), text("close").alias("CLOSE"), text("volume").alias("Volume"), F.lit(1).alias("Arrival"))
    again = raw.withColumn("Arrival", F.lit(2)).withColumn("CLOSE", F.lit("1"))
    later = again.join(raw.where("CLOSE != 'n/a'").select(" Date", "Ticker"), [" Date", "Ticker"], "left_semi").select(*raw.columns)
    return op.normalise_ohlcv(raw.unionByName(later), ticker="none", arrival="Arrival")


@query("norm_price_csv", f"SELECT date, 'orders' AS source, {r(price='price')} FROM fallback_price WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND day(date) % 10 <> 0")
def norm_price_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.fallback_price(spark, sf_dir)
    raw = f.select(F.concat(F.lit(" "), F.col("date").cast("string")).alias("DATE"), F.when(F.dayofmonth("date") % 10 == 0, F.lit(".")).otherwise(F.col("price").cast("string")).alias(" Gold_Price "), F.lit(1).alias("arrival"))
    return shown(op.normalise_price_csv(raw, source="orders", arrival="arrival", start="1996-01-01", end="2000-12-31"), ["date", "source"], ["price"])


_EV = "SELECT CAST(ts AS DATE) AS date, event_type AS series_id, event_id, value FROM events WHERE event_id % 10 <> 0"


@query("norm_series_json", f", e AS ({_EV}) SELECT date, series_id, {r(value='value')} FROM e QUALIFY row_number() OVER (PARTITION BY date, series_id ORDER BY event_id DESC) = 1")
def norm_series_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of 5000 events at most for each event type and day; every tenth value is a dot."""
    e = views.table(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    text = F.when(F.col("event_id") % 10 == 0, F.lit(".")).otherwise(F.col("value").cast("string"))
    item = F.struct(F.col("event_id").alias("o"), F.col("date").cast("string").alias("date"), text.alias("value"))
    raw = e.groupBy("event_type", "date", F.floor(F.col("event_id") / 5000).alias("page")).agg(F.sort_array(F.collect_list(item)).alias("x"))
    raw = raw.select("event_type", "page", F.to_json(F.struct(F.transform("x", lambda v: F.struct(v["date"].alias("date"), v["value"].alias("value"))).alias("observations"))).alias("body"))
    return shown(op.normalise_series_json(raw, series="event_type", body="body", page="page"), ["date", "series_id"], ["value"])


@query("norm_paged_union", f", e AS ({_EV}) SELECT date, series_id, {r(value='value')} FROM e QUALIFY row_number() OVER (PARTITION BY date, series_id ORDER BY event_id) = 1")
def norm_paged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 5000 events; every tenth value is a dot."""
    e = views.table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 10 == 0, F.lit(".")).otherwise(F.col("value").cast("string"))
    item = F.struct(F.col("event_id").alias("o"), F.col("ts").cast("date").cast("string").alias("period"), F.col("event_type").alias("series"), text.alias("value"))
    pages = e.groupBy(F.floor(F.col("event_id") / 5000).alias("page")).agg(F.sort_array(F.collect_list(item)).alias("x"))
    pages = pages.select("page", F.to_json(F.struct(F.struct(F.transform("x", lambda v: F.struct(v["period"].alias("period"), v["series"].alias("series"), v["value"].alias("value"))).alias("data")).alias("response"))).alias("body"))
    return shown(op.normalise_paged_json(pages, body="body", page="page"), ["date", "series_id"], ["value"])


@query("norm_positioning", "SELECT 'market' AS market, lpad(CAST(ord(contract) AS VARCHAR), 6, '0') AS code, report_date, available_date, open_interest, longs, shorts FROM positioning WHERE contract = 'O'")
def norm_positioning(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.positioning(spark, sf_dir)
    num = lambda c: F.format_number(F.col(c), 1)
    raw = p.select(F.lit("market").alias("Market "), F.ascii("contract").cast("string").alias("Code"), F.when(F.dayofmonth("report_date") % 2 == 0, F.col("report_date").cast("string")).alias("Report_Date"), F.concat(F.regexp_replace(F.date_format("report_date", "yyMMdd"), "^0+", ""), F.lit(".0")).alias("YYMMDD"), *(num(c).alias(c.upper()) for c in op.POSITION_COLS), F.lit(1).alias("arrival"))
    return op.normalise_positioning(raw, code=str(ord("O")), arrival="arrival")


@query("complete_session_filter", "SELECT series, date, close FROM bars WHERE date <= DATE '2000-06-16'")
def complete_session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seen from Sunday noon, 18 June 2000, New York: Friday is the last complete session."""
    return op.complete_sessions(views.bars(spark, sf_dir), time="date", now=F.lit("2000-06-18 16:00:00").cast("timestamp")).select("series", "date", "close")
