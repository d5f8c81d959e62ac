"""The views that carry the engine's data model on the given tables, for Spark and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.chunks import parts_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str, key: str = "l_returnflag", dealt: bool = False) -> DataFrame:
    """Daily open, high, low, close, volume by series. ``dealt``, for many series: a series' lines go to one task, and all that works by series after that needs no other shuffle."""
    k = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    lines = table(spark, sf_dir, "lineitem")
    if dealt:
        lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date")).repartition(parts_of(lines.count()), key)
    return (
        lines.groupBy(F.col(key).alias("series"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.min_by("l_extendedprice", k).alias("open"), F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"), F.max_by("l_extendedprice", k).alias("close"), F.sum("l_quantity").alias("volume"))
    )


def bars_many(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    return bars(spark, sf_dir, "l_suppkey", dealt)


def bars_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.dayofmonth("date")
    gone = {c: F.when(day % 7 != 0, F.col(c)) for c in ("open", "high", "low", "volume")}
    return bars(spark, sf_dir).withColumns({**gone, "close": F.when(day % 11 != 0, F.col("close"))})


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders' shipments as one long series of bars: a bar for each order and day, in the order of day and order."""
    k = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    tick = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 10_000_000_000 + F.col("l_orderkey")
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.withColumn("tick", tick).repartition(parts_of(lines.count()), "tick").groupBy(F.lit("all").alias("series"), "tick")
        .agg(F.min_by("l_extendedprice", k).alias("open"), F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"), F.max_by("l_extendedprice", k).alias("close"), F.sum("l_quantity").alias("volume"))
    )


def ticks_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = {c: F.when(F.col("tick") % 7 != 0, F.col(c)) for c in ("open", "high", "low", "volume")}
    return ticks(spark, sf_dir).withColumns({**gone, "close": F.when(F.col("tick") % 11 != 0, F.col("close"))})


def macro_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderpriority").alias("series_id")).agg(F.avg("o_totalprice").alias("value"))


def macro_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "month").alias("date"), F.col("o_orderpriority").alias("series_id")).agg(F.avg("o_totalprice").alias("value"))


def fallback_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.avg("o_totalprice").alias("price"))


def spot(spark: SparkSession, sf_dir: str, series_id: str) -> DataFrame:
    return macro_daily(spark, sf_dir).where(F.col("series_id") == series_id).select("date", "value")


def bars_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a day: A is the primary series, N and R are cross series."""
    cols = ["open", "high", "low", "close", "volume"]
    b = bars(spark, sf_dir)
    pick = lambda s, c: F.max(F.when(F.col("series") == s, F.col(c))).alias(f"{s.lower()}_{c}")
    return b.groupBy("date").agg(*(pick(s, c) for s in "ANR" for c in cols))


def positioning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly reports by contract, published three days later."""
    li = table(spark, sf_dir, "lineitem")
    part = lambda f, name: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity")).otherwise(0.0)).alias(name)
    p = li.groupBy(F.col("l_linestatus").alias("contract"), F.date_trunc("week", "l_shipdate").cast("date").alias("report_date")).agg(F.sum("l_quantity").alias("open_interest"), part("A", "longs"), part("R", "shorts"), part("N", "others"))
    w = Window.partitionBy("contract").orderBy("report_date")
    return p.withColumn("available_date", F.date_add("report_date", 3)).withColumn("change", F.col("open_interest") - F.lag("open_interest").over(w))


def dup_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = macro_daily(spark, sf_dir)
    return m.withColumn("arrival", F.lit(1)).unionByName(m.withColumn("value", F.col("value") + 1).withColumn("arrival", F.lit(2)))


def naive_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten steps ahead from every row by two naive models."""
    w = Window.partitionBy("series").orderBy("date")
    b = bars(spark, sf_dir).withColumn("sma20", F.avg("close").over(w.rowsBetween(-19, 0)))
    ahead = [F.struct(F.lit(h).alias("step"), F.lead("date", h).over(w).alias("forecast_date"), F.lead("open", h).over(w).alias("actual_price")) for h in range(1, 11)]
    b = b.withColumn("a", F.array(*ahead)).withColumn("m", F.array(F.struct(F.lit("last_close").alias("model"), F.col("close").alias("predicted")), F.struct(F.lit("sma20").alias("model"), F.col("sma20").alias("predicted"))))
    b = b.select("series", F.col("date").alias("cutoff_date"), F.col("close").alias("current_price"), F.explode("a").alias("a"), "m")
    return b.select("series", "cutoff_date", "current_price", "a.*", F.explode("m").alias("m")).select("series", "cutoff_date", "forecast_date", "step", "m.model", "current_price", "actual_price", "m.predicted").where("forecast_date is not null")


RUNS = [("run1", "last_close"), ("run2", "sma20")]


def runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RUNS, "run_id string, selected_model string")


_K = "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey"
_BARS = f"""SELECT {{key}} AS series, CAST(l_shipdate AS DATE) AS date, first(l_extendedprice {_K}) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    last(l_extendedprice {_K}) AS close, sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2"""
_T = "ORDER BY l_linenumber, l_partkey, l_suppkey"
_TICKS = f"""SELECT 'all' AS series, (CAST(l_shipdate AS DATE) - DATE '1970-01-01') * 10000000000 + l_orderkey AS tick, first(l_extendedprice {_T}) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
    last(l_extendedprice {_T}) AS close, sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2"""
_WIDE = ", ".join(f"max({c}) FILTER (WHERE series = '{s}') AS {s.lower()}_{c}" for s in "ANR" for c in ("open", "high", "low", "close", "volume"))
_STEPS = ", ".join(f"({h})" for h in range(1, 11))
SQL = f"""
bars AS ({_BARS.format(key="l_returnflag")}),
bars_many AS ({_BARS.format(key="l_suppkey")}),
bars_gaps AS (SELECT series, date, CASE WHEN day(date) % 7 <> 0 THEN open END AS open, CASE WHEN day(date) % 7 <> 0 THEN high END AS high, CASE WHEN day(date) % 7 <> 0 THEN low END AS low,
    CASE WHEN day(date) % 11 <> 0 THEN close END AS close, CASE WHEN day(date) % 7 <> 0 THEN volume END AS volume FROM bars),
ticks AS ({_TICKS}),
ticks_gaps AS (SELECT series, tick, {", ".join(f"CASE WHEN tick % {11 if c == 'close' else 7} <> 0 THEN {c} END AS {c}" for c in ("open", "high", "low", "close", "volume"))} FROM ticks),
macro_daily AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS series_id, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2),
macro_monthly AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_orderpriority AS series_id, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2),
fallback_price AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
primary_spot AS (SELECT date, value FROM macro_daily WHERE series_id = '1-URGENT'),
fallback_spot AS (SELECT date, value FROM macro_daily WHERE series_id = '2-HIGH'),
bars_wide AS (SELECT date, {_WIDE} FROM bars GROUP BY date),
reports AS (SELECT l_linestatus AS contract, CAST(date_trunc('week', l_shipdate) AS DATE) AS report_date, sum(l_quantity) AS open_interest, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) AS longs,
    coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS shorts, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0) AS others FROM lineitem GROUP BY 1, 2),
positioning AS (SELECT *, report_date + 3 AS available_date, open_interest - lag(open_interest) OVER (PARTITION BY contract ORDER BY report_date) AS change FROM reports),
dup_series AS (SELECT *, 1 AS arrival FROM macro_daily UNION ALL SELECT date, series_id, value + 1, 2 FROM macro_daily),
numbered AS (SELECT *, avg(close) OVER (PARTITION BY series ORDER BY date ROWS 19 PRECEDING) AS sma20, row_number() OVER (PARTITION BY series ORDER BY date) AS rn FROM bars),
naive_predictions AS (SELECT c.series, c.date AS cutoff_date, f.date AS forecast_date, CAST(s.step AS INTEGER) AS step, m.model, c.close AS current_price, f.open AS actual_price, CASE m.model WHEN 'sma20' THEN c.sma20 ELSE c.close END AS predicted
    FROM numbered c CROSS JOIN (VALUES {_STEPS}) s(step) JOIN numbered f ON f.series = c.series AND f.rn = c.rn + s.step CROSS JOIN (VALUES ('last_close'), ('sma20')) m(model)),
runs AS (SELECT * FROM (VALUES ('run1', 'last_close'), ('run2', 'sma20')) r(run_id, selected_model))
"""


def sql(body: str) -> str:
    """A DuckDB query over the views; ``body`` may start with more of them, after a comma."""
    return f"WITH {SQL.strip()}{body if body.lstrip().startswith(',') else ' ' + body}"
