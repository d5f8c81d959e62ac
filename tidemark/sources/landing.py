"""Landed payloads to typed tables. Sources arrive as text; values that don't parse become null and are dropped where the key needs them."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BAR_COLS = ["open", "high", "low", "close", "volume"]


def _first(df: DataFrame, on: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*on).orderBy(*order))).where("_rn = 1").drop("_rn")


def number(c: str | Column) -> Column:
    """Text as a number: null where it isn't one, or isn't finite."""
    x = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def normalise_ohlcv(raw: DataFrame, *, ticker: str, arrival: str) -> DataFrame:
    """Lower-case headers, missing columns as null, rows without a close dropped, the first to arrive of each (date, ticker)."""
    df = raw.toDF(*(c.strip().lower() for c in raw.columns))
    have = {*df.columns}
    cols = [(number(c) if c in have else F.lit(None).cast("double")).alias(c) for c in BAR_COLS]
    df = df.select(F.expr("try_cast(substr(cast(date as string), 1, 10) as date)").alias("date"), *([F.col("ticker")] if "ticker" in have else [F.lit(ticker).alias("ticker")]), *cols, F.col(arrival.lower()).alias("_o"))
    return _first(df.where("date is not null and close is not null"), ["date", "ticker"], [F.col("_o")]).drop("_o")


PRICE_NAMES = ["price", "value", "close", "gold_price", "gold"]


def normalise_price_csv(raw: DataFrame, *, source: str, arrival: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """(date, price, source) from the first known price column; rows that don't parse or lie outside of the range go; the first of each date."""
    df = raw.toDF(*(c.strip().lower() for c in raw.columns))
    name = next((c for c in PRICE_NAMES if c in df.columns), None)
    if name is None or "date" not in df.columns:
        raise ValueError(f"no date or price column among {df.columns}")
    df = df.select(F.expr("try_cast(trim(date) as date)").alias("date"), number(name).alias("price"), F.col(arrival.lower()).alias("_o")).where("date is not null and price is not null")
    df = df.where(F.col("date") >= start) if start else df
    df = df.where(F.col("date") <= end) if end else df
    return _first(df, ["date"], [F.col("_o")]).select("date", "price", F.lit(source).alias("source"))


def normalise_series_json(raw: DataFrame, *, series: str, body: str, page: str | None = None) -> DataFrame:
    """(date, series_id, value) from bodies {"observations": [{date, value}]}; of a date that comes twice the last stays, in the order of
    ``page`` where a series has several bodies."""
    schema = "observations array<struct<date: string, value: string>>"
    df = raw.select(F.col(series).alias("series_id"), (F.col(page) if page else F.lit(0)).alias("_p"), F.posexplode(F.from_json(body, schema)["observations"]).alias("_o", "x"))
    df = df.select(F.expr("try_cast(x.date as date)").alias("date"), "series_id", number(F.col("x.value")).alias("value"), "_p", "_o").where("date is not null and value is not null")
    return _first(df, ["date", "series_id"], [F.desc("_p"), F.desc("_o")]).drop("_p", "_o")


def normalise_paged_json(pages: DataFrame, *, body: str, page: str) -> DataFrame:
    """(date, series_id, value) from pages {"response": {"data": [{period, series, value}]}}; the first of each (date, series) in page order."""
    schema = "response struct<data: array<struct<period: string, series: string, value: string>>>"
    df = pages.select(F.col(page).alias("_p"), F.posexplode(F.from_json(body, schema)["response"]["data"]).alias("_o", "x"))
    df = df.select(F.expr("try_cast(x.period as date)").alias("date"), F.col("x.series").alias("series_id"), number(F.col("x.value")).alias("value"), "_p", "_o").where("date is not null and value is not null")
    return _first(df, ["date", "series_id"], [F.col("_p"), F.col("_o")]).drop("_p", "_o")


POSITION_COLS = ["open_interest", "longs", "shorts"]


def _compact_date(c: str) -> Column:
    """A date yymmdd, also one that was read as a number; years from 69 on are of the twentieth century."""
    text = F.lpad(F.regexp_replace(F.col(c).cast("string"), r"\.0$", ""), 6, "0")
    century = F.when(F.substring(text, 1, 2) >= "69", "19").otherwise("20")
    return F.to_date(F.try_to_timestamp(F.concat(century, text), F.lit("yyyyMMdd")))


def normalise_positioning(raw: DataFrame, *, code: str | None, arrival: str, lag_days: int = 3) -> DataFrame:
    """Reports with their day of publication. A compact date yymmdd stands in where there is no report_date; codes are padded to six places;
    of a report that comes twice the last stays. Missing columns raise."""
    df = raw.toDF(*(c.strip().lower() for c in raw.columns))
    need = {"market", "code", *POSITION_COLS} - {*df.columns}
    if need or not {"report_date", "yymmdd"} & {*df.columns}:
        raise ValueError(f"missing columns: {sorted(need) or ['report_date']}")
    compact = _compact_date("yymmdd") if "yymmdd" in df.columns else F.lit(None).cast("date")
    plain = F.expr("try_cast(report_date as date)") if "report_date" in df.columns else F.lit(None).cast("date")
    df = df.select(
        "market", F.lpad(F.trim(F.col("code").cast("string")), 6, "0").alias("code"), F.coalesce(plain, compact).alias("report_date"), *(number(F.regexp_replace(F.col(c).cast("string"), ",", "")).alias(c) for c in POSITION_COLS), F.col(arrival.lower()).alias("_o")
    ).where("report_date is not null and open_interest is not null")
    df = df.where(F.col("code") == F.lpad(F.lit(code), 6, "0")) if code else df
    df = df.withColumn("available_date", F.date_add("report_date", lag_days))
    return _first(df, ["report_date", "code"], [F.desc("_o")]).drop("_o")


def read_positional(spark: SparkSession, path: str, *, columns: dict[int, str]) -> DataFrame:
    """Headerless CSV: the columns of the given positions, as text."""
    df = spark.read.csv(path, header=False, inferSchema=False)
    return df.select(*(F.col(f"_c{i}").alias(n) for i, n in columns.items()))


def read_zipped_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the first member of each archive as text: (file, line, values by header). Every archive is read in pieces by one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as f:
                    at = 0
                    for part in pd.read_csv(f, dtype=str, chunksize=10_000, keep_default_na=False):
                        yield pd.DataFrame({"file": name, "line": range(at, at + len(part)), "values": part.rename(columns=str.strip).to_dict("records")})
                        at += len(part)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, line long, values map<string, string>")


def complete_sessions(df: DataFrame, *, time: str, now: Column, zone: str = "America/New_York", close_hour: int = 18) -> DataFrame:
    """Rows up to the last complete session at ``now`` (UTC): before the safe close the day before, weekends roll back to Friday."""
    local = F.from_utc_timestamp(now, zone)
    day = F.when(F.hour(local) < close_hour, F.date_sub(F.to_date(local), 1)).otherwise(F.to_date(local))
    cutoff = F.when(F.weekday(day) == 5, F.date_sub(day, 1)).when(F.weekday(day) == 6, F.date_sub(day, 2)).otherwise(day)
    return df.where(F.col(time) <= cutoff)


def write_tables(tables: dict[str, DataFrame], path: str, *, keep: tuple[str, ...] = ()) -> None:
    """Full refresh: every table is replaced, those in ``keep`` are appended to."""
    for name, df in tables.items():
        df.write.mode("append" if name in keep else "overwrite").parquet(f"{path}/{name}")


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
