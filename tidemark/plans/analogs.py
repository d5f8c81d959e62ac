"""Queries of the historical analogs; their SQL is the plain inequality join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import analogs as op
from ..operators import projections
from . import views
from .indicators import BY, ID, over
from .projections import _PTD, pct
from .registry import query, r, shown

_W = "PARTITION BY series ORDER BY date"
_F = ", ".join(f"{pct(f'lead(close, {h}) OVER ({_W})', 'close')} AS f{h}" for h in (5, 7, 10, 21))
_HIST = f""", h0 AS (SELECT series, date, close, {_F}, {pct('close', f'lag(close, 21) OVER ({_W})')} AS ret, {pct('close', f'lag(close) OVER ({_W})')} AS d1 FROM bars),
h AS (SELECT *, {over('stddev_samp(d1)', 21)} AS vol FROM h0)"""


def _stats(name: str, spec: dict[int, str]) -> dict[str, str]:
    out = {}
    for k, what in spec.items():
        made = {"m": ("mean", f"avg(h.f{k})"), "s": ("sd", f"stddev_samp(h.f{k})"), "u": ("up", f"avg(CASE WHEN h.f{k} > 0 THEN 1.0 WHEN h.f{k} <= 0 THEN 0.0 END)"), "n": ("n", f"count(h.f{k})")}
        out |= {f"{name}_{made[c][0]}_{k}": made[c][1] for c in what}
    return out


def _sql(name: str, spec: dict[int, str], near: str) -> str:
    s = _stats(name, spec)
    floats, counts = {n: e for n, e in s.items() if "_n_" not in n}, {n: e for n, e in s.items() if "_n_" in n}
    return _HIST + f" SELECT c.series, c.date, {r(**floats)}, {', '.join(f'{e} AS {n}' for n, e in counts.items())} FROM h c LEFT JOIN h ON h.series = c.series AND h.date <= c.date - INTERVAL 1 YEAR AND {near} GROUP BY c.series, c.date"


def _show(df: DataFrame, name: str, spec: dict[int, str]) -> DataFrame:
    s = _stats(name, spec)
    return shown(df, [*ID, *(n for n in s if "_n_" in n)], [n for n in s if "_n_" not in n])


MONTH, QUARTER = {5: "msun", 7: "mun", 21: "mun"}, {21: "mun"}
DAY, REGIME = {5: "msun", 7: "mun", 10: "mu", 21: "mun"}, {5: "mun", 7: "mun", 10: "mu", 21: "mun"}
_CIRCLE = "least(abs(dayofyear(h.date) - dayofyear(c.date)), 366 - abs(dayofyear(h.date) - dayofyear(c.date))) <= 10"


@query("analog_same_month", _sql("month", MONTH, "month(h.date) = month(c.date)"))
def analog_same_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(op.same_month(op.future_returns(views.bars(spark, sf_dir), **BY), **BY), "month", MONTH)


@query("analog_same_month_many", _sql("month", MONTH, "month(h.date) = month(c.date)").replace("FROM bars)", "FROM bars_many)"))
def analog_same_month_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(op.same_month(op.future_returns(views.bars_many(spark, sf_dir), **BY), **BY), "month", MONTH)


@query("analog_same_quarter", _sql("quarter", QUARTER, "quarter(h.date) = quarter(c.date)"))
def analog_same_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(op.same_quarter(op.future_returns(views.bars(spark, sf_dir), **BY), **BY), "quarter", QUARTER)


@query("analog_day_of_year", _sql("day", DAY, _CIRCLE))
def analog_day_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show(op.day_of_year(op.future_returns(views.bars(spark, sf_dir), **BY), **BY), "day", DAY)


@query("analog_regime", _sql("regime", REGIME, "abs(c.ret - h.ret) <= 2.0 AND abs(c.vol - h.vol) <= 20"))
def analog_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars of these tables move far more than a market's, so the volatility box is 20."""
    return _show(op.regime(op.future_returns(views.bars(spark, sf_dir), **BY), **BY, vol_box=20.0), "regime", REGIME)


_SEASON = _stats("month", MONTH)


@query("seasonality_features", _HIST + f""", mo AS (SELECT c.series, c.date, {', '.join(f'{e} AS {n}' for n, e in _SEASON.items())} FROM h c LEFT JOIN h ON h.series = c.series AND h.date <= c.date - INTERVAL 1 YEAR AND month(h.date) = month(c.date) GROUP BY c.series, c.date)
SELECT series, date, CAST(month(date) AS INTEGER) AS month, {r(6, month_sin='sin(2 * pi() * month(date) / 12)')}, {r(mtd_return=_PTD['mtd_return'], ytd_return=_PTD['ytd_return'], year_progress='(dayofyear(date) - 1) / 365.25', **{n: n for n in _SEASON if '_n_' not in n})}, {', '.join(n for n in _SEASON if '_n_' in n)} FROM bars JOIN mo USING (series, date)""")
def seasonality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar parts, cycles, progress, period returns and the month analog in one table."""
    df = op.same_month(op.future_returns(views.bars(spark, sf_dir), **BY), **BY)
    df = projections.calendar_progress(projections.calendar_cyclic(projections.calendar_parts(projections.period_to_date(df, **BY), time="date"), time="date"), time="date")
    counts, floats = [n for n in _SEASON if "_n_" in n], [n for n in _SEASON if "_n_" not in n]
    rest = ["mtd_return", "ytd_return", "year_progress", *floats]
    return shown(shown(df, [*ID, "month", *rest, *counts], ["month_sin"], 6), [*ID, "month", "month_sin", *counts], rest)
