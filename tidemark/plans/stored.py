"""Queries of the sinks: each writes to the shared folder and reads back, so that what is compared went through the files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import shared_folder, stored
from ..operators import forecast, joins, projections
from ..sources import landing
from ..sources.store import Store
from . import views
from .forecast import _DIRECTION
from .indicators import BY, ID
from .joins import _NEW, _UP, _base_new
from .registry import query, r, shown

KEYS = ["date", "series_id"]


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"


@query("store_upsert", f", a AS ({_UP}), b AS ({_NEW}) SELECT date, series_id, {r(value='value')} FROM (SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.date = a.date AND b.series_id = a.series_id)) x")
def store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table of buckets, twice: the second run finds nothing to do. It gets the very rows of the first: averages of doubles computed again may differ in their last bits, as the order of a shuffle does."""
    a, b = _base_new(spark, sf_dir)
    b = stored(b)
    store = Store(spark, _folder(spark), buckets=8)
    store.upsert("macro", a, keys=KEYS)
    first = store.upsert("macro", b, keys=KEYS)
    again = store.upsert("macro", b, keys=KEYS)
    if (again["version"], again["buckets"]) != (first["version"], 0):
        raise RuntimeError("running an upsert again changed the store")
    return shown(store.read("macro"), KEYS, ["value"])


@query("store_upsert_subset", f", a AS (SELECT *, 'base' AS note FROM ({_UP})), b AS ({_NEW}), c AS (SELECT date, series_id, -1.0 AS value FROM macro_daily) SELECT date, series_id, {r(value='coalesce(CASE WHEN b.date IS NOT NULL THEN b.value ELSE a.value END, CASE WHEN a.date IS NULL AND b.date IS NULL THEN c.value END)')}, a.note FROM a FULL JOIN b USING (date, series_id) FULL JOIN c USING (date, series_id)")
def store_upsert_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some columns only, then rows that are only added where their key is new."""
    a, b = _base_new(spark, sf_dir)
    store = Store(spark, _folder(spark), buckets=8)
    store.upsert("macro", a.withColumn("note", F.lit("base")), keys=KEYS)
    store.upsert("macro", b, keys=KEYS, mode="subset")
    store.upsert("macro", views.macro_daily(spark, sf_dir).select(*KEYS, F.lit(-1.0).alias("value")), keys=KEYS, mode="ignore")
    return shown(store.read("macro"), [*KEYS, "note"], ["value"])


@query("store_refresh", " SELECT 'bars' AS name, count(*) AS rows FROM bars UNION ALL SELECT 'macro', count(*) FROM macro_monthly UNION ALL SELECT 'history', count(*) FROM macro_daily")
def store_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables are replaced at once; the third is history and stays."""
    store = Store(spark, _folder(spark), buckets=8)
    store.upsert("history", views.macro_daily(spark, sf_dir), keys=KEYS)
    store.refresh({"bars": (views.bars(spark, sf_dir).where("series = 'A'"), ID), "macro": (views.macro_daily(spark, sf_dir), KEYS)})
    store.refresh({"bars": (views.bars(spark, sf_dir), ID), "macro": (views.macro_monthly(spark, sf_dir), KEYS)})
    counted = [store.read(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n in ("bars", "macro", "history")]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("report_sink", f" SELECT series, step, model, {_DIRECTION} AS direction, count(*) AS n FROM naive_predictions GROUP BY 1, 2, 3, 4")
def report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as CSV with a header, read back."""
    path, p = _folder(spark), views.naive_predictions(spark, sf_dir)
    report = p.withColumn("direction", forecast.direction(F.col("current_price"), F.col("predicted"))).groupBy("series", "step", "model", "direction").agg(F.count("*").alias("n"))
    landing.write_report(report, path)
    return spark.read.csv(path, header=True, schema="series string, step int, model string, direction string, n long")


_SAFE = ["close", "high", "low", "volume"]


@query("safe_features", ", l AS (SELECT * FROM bars_gaps WHERE open IS NOT NULL AND close IS NOT NULL) " + " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n FROM l" for c in _SAFE))
def safe_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of bars with their labels, the columns that a model may see: the next opens are targets, and the open is barred; each with its number of values."""
    df = projections.target_labels(views.bars_gaps(spark, sf_dir), **BY)
    cols = projections.safe_features(df, blocked=[f"next_{h}_open" for h in range(1, 11)], unsafe=["open"])
    return df.agg(*(F.count(c).alias(c) for c in cols)).unpivot([], cols, "feature", "n")


@query("one_to_one", f", s AS (SELECT series, cutoff_date, forecast_date, step, predicted AS sma20 FROM naive_predictions WHERE model = 'sma20'), c AS (SELECT series, cutoff_date, step, predicted AS last_close FROM naive_predictions WHERE model = 'last_close') SELECT series, cutoff_date, step, {r(6, gap='sma20 - last_close')} FROM s JOIN c USING (series, cutoff_date, step)")
def one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models' forecasts side by side; a forecast that the other model lacks, or has twice, is an error."""
    p, on = views.naive_predictions(spark, sf_dir), ["series", "cutoff_date", "step"]
    of = lambda m: p.where(F.col("model") == m).select(*on, F.col("predicted").alias(m))
    return shown(joins.one_to_one(of("sma20"), of("last_close"), on=on).withColumn("gap", F.col("sma20") - F.col("last_close")), on, ["gap"], 6)
