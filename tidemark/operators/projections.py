"""Projections of a daily row: coalescing, guarded ratios, bar shape, changes, calendar parts and regimes."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rolling import Step, rolling
from ..functions.windows import ordered, percent, ratio, trailing


def macro_projection(df: DataFrame, *, short: str, long: str, slope: str) -> DataFrame:
    """The slope as given, else the difference of the two yields."""
    return df.withColumn("yield_slope", F.coalesce(F.col(slope), F.col(long) - F.col(short)))


def ratio_features(df: DataFrame, *, primary: str, others: dict[str, str]) -> DataFrame:
    """Guarded ratio and plain spread of the primary price to each other one (name to column)."""
    out: dict[str, Column] = {}
    for name, c in others.items():
        out |= {f"ratio_{name}": ratio(F.col(primary), F.col(c)), f"spread_{name}": F.col(primary) - F.col(c)}
    return df.withColumns(out)


def bar_shape(df: DataFrame, *, keys: list[str], time: str) -> DataFrame:
    """Overnight gap, intraday change and range in percent, and where in the range the close lies."""
    before = F.lag("close").over(ordered(keys, time))
    return df.withColumns({
        "gap_pct": percent(F.col("open"), before), "intraday_pct": percent(F.col("close"), F.col("open")),
        "range_pct": 100 * ratio(F.col("high") - F.col("low"), F.col("open")), "close_location": ratio(F.col("close") - F.col("low"), F.col("high") - F.col("low")),
    })


def pct_change_k(df: DataFrame, *, keys: list[str], time: str, col: str, steps: list[int]) -> DataFrame:
    before = {k: F.lag(col, k).over(ordered(keys, time)) for k in steps}
    return df.withColumns({f"{col}_change_{k}": percent(F.col(col), b) for k, b in before.items()} | {f"{col}_diff_{k}": F.col(col) - b for k, b in before.items()})


def positioning_features(df: DataFrame, *, keys: list[str], time: str, n: int = 52, as_of: str | None = None) -> DataFrame:
    """Net position, its share of open interest and change, its score over n reports, and the report's age at ``as_of``."""
    w = trailing(keys, time, n)
    df = df.withColumn("net", F.col("longs") - F.col("shorts")).withColumn("net_pct_oi", 100 * ratio(F.col("net"), F.col("open_interest")))
    df = df.withColumn("net_change_pct_oi", 100 * ratio(F.col("net") - F.lag("net").over(ordered(keys, time)), F.col("open_interest")))
    df = df.withColumn("net_zscore", ratio(F.col("net_pct_oi") - F.avg("net_pct_oi").over(w), F.stddev_samp("net_pct_oi").over(w)))
    return df.withColumn("age_days", F.datediff(F.col(as_of), F.col(time))) if as_of else df


def calendar_parts(df: DataFrame, *, time: str) -> DataFrame:
    return df.withColumns({"month": F.month(time), "quarter": F.quarter(time), "week": F.weekofyear(time), "day_of_year": F.dayofyear(time)})


def calendar_cyclic(df: DataFrame, *, time: str) -> DataFrame:
    month, day = 2 * F.pi() * F.month(time) / 12, 2 * F.pi() * F.dayofyear(time) / 365.25
    return df.withColumns({"month_sin": F.sin(month), "month_cos": F.cos(month), "day_sin": F.sin(day), "day_cos": F.cos(day)})


def calendar_progress(df: DataFrame, *, time: str) -> DataFrame:
    """How much of the month, quarter and year has gone, and days to the next first of January."""
    t, q = F.col(time), F.trunc(time, "quarter")
    return df.withColumns({
        "month_progress": (F.dayofmonth(t) - 1) / F.dayofmonth(F.last_day(t)), "quarter_progress": F.datediff(t, q) / F.datediff(F.add_months(q, 3), q),
        "year_progress": (F.dayofyear(t) - 1) / F.lit(365.25), "days_to_new_year": F.datediff(F.add_months(F.trunc(time, "year"), 12), t),
    })


def _log(x: Column) -> Column:
    return F.when(x > 0, F.log(F.when(x > 0, x)))


def log_bar_features(df: DataFrame, *, keys: list[str], time: str) -> DataFrame:
    """Log return, overnight gap and intraday return; prices that aren't positive give null."""
    before = F.lag("close").over(ordered(keys, time))
    return df.withColumns({"log_return": _log(F.col("close")) - _log(before), "log_gap": _log(F.col("open")) - _log(before), "log_intraday": _log(F.col("close")) - _log(F.col("open"))})


def log_return_lags(df: DataFrame, *, keys: list[str], time: str, lags: tuple[int, ...] = (1, 2, 3, 5, 10, 21, 63, 126, 252)) -> DataFrame:
    o = ordered(keys, time)
    df = df.withColumn("log_return", _log(F.col("close")) - _log(F.lag("close").over(o)))
    return df.withColumns({f"log_return_lag_{k}": F.lag("log_return", k).over(o) for k in lags})


def rolling_return_stats(df: DataFrame, *, keys: list[str], time: str, spans: tuple[int, ...] = (5, 10, 21, 63, 126, 252)) -> DataFrame:
    """Statistics over full windows only: return mean, deviation and extremes, price to mean, slope, drawdown and rebound."""
    o, out = ordered(keys, time), {}
    df = df.withColumn("log_return", _log(F.col("close")) - _log(F.lag("close").over(o)))
    df = df.withColumns({"_x": F.col("close").cast("double"), **{f"slope_{n}": (_log(F.col("close")) - _log(F.lag("close", n).over(o))) / n for n in spans}})
    for n in spans:
        out |= {f"return_{kind}_{n}": (kind, "log_return", n) for kind in ("mean", "sd", "min", "max")}
        out |= {f"{name}_{n}": (kind, "_x", n) for name, kind in (("price_to_mean", "mean"), ("drawdown", "max"), ("rebound", "min"))}
    df = rolling(df.drop(*out), keys=keys, time=time, steps=[out], whole=True)
    return df.withColumns({f"{name}_{n}": percent(F.col("_x"), F.col(f"{name}_{n}")) for n in spans for name in ("price_to_mean", "drawdown", "rebound")}).drop("_x")


def log_volume(volume: str = "volume") -> Column:
    """log(1 + volume); negative volumes count as none."""
    return F.log1p(F.when(F.col(volume).isNotNull() & ~F.isnan(volume), F.greatest(F.col(volume), F.lit(0.0))))


def volume_zscore(df: DataFrame, *, keys: list[str], time: str, spans: tuple[int, ...] = (21, 63, 252)) -> DataFrame:
    """Score of log(1 + volume) over full windows; negative volumes count as none."""
    df = df.withColumn("_v", log_volume())
    out = {f"_{kind}_{n}": (kind, "_v", n) for n in spans for kind in ("mean", "sd")}
    df = rolling(df, keys=keys, time=time, steps=[out], whole=True)
    return df.withColumns({f"volume_zscore_{n}": ratio(F.col("_v") - F.col(f"_mean_{n}"), F.col(f"_sd_{n}")) for n in spans}).drop("_v", *out)


def return_steps(n: int = 21) -> list[Step]:
    """Price to mean and deviation of the return as :func:`rolling_return_stats` has them, and :func:`volume_zscore`, as steps over full windows where a series' rows are one group. They take
    ``log_return``, the price ``_x`` and the :func:`log_volume` ``_v``."""

    def guarded(a: pa.Array, b: pa.Array) -> pa.Array:
        return pc.if_else(pc.greater(b, 0.0), pc.divide(a, b), None)

    mean, v, v_mean, v_sd = f"_x_mean_{n}", "_v", f"_v_mean_{n}", f"_v_sd_{n}"
    return [
        {f"return_sd_{n}": ("sd", "log_return", n), mean: ("mean", "_x", n), v_mean: ("mean", v, n), v_sd: ("sd", v, n)},
        (f"price_to_mean_{n}", lambda b: pc.multiply(pc.subtract(guarded(b.column("_x"), b.column(mean)), 1.0), 100.0)),
        (f"volume_zscore_{n}", lambda b: guarded(pc.subtract(b.column(v), b.column(v_mean)), b.column(v_sd))),
    ]


def rolling_zscore(df: DataFrame, *, keys: list[str], time: str, col: str, n: int) -> DataFrame:
    w = trailing(keys, time, n)
    return df.withColumn(f"{col}_zscore_{n}", ratio(F.col(col) - F.avg(col).over(w), F.stddev_samp(col).over(w)))


def binned(x: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Right-closed bins; null stays null."""
    first = F.when(x.isNull(), F.lit(None).cast("string"))
    return reduce(lambda a, e: a.when(x <= e[0], F.lit(e[1])), edges, first).otherwise(F.lit(last))


def regime_bins(df: DataFrame, *, keys: list[str], time: str, price: str, other: str) -> DataFrame:
    """Momentum over 21 rows, volatility over 21 rows and relative strength, as named regimes."""
    o, w = ordered(keys, time), trailing(keys, time, 21)
    df = df.withColumns({"_m": percent(F.col(price), F.lag(price, 21).over(o)), "_r": ratio(F.col(price), F.col(other)), "_d": percent(F.col(price), F.lag(price).over(o))})
    df = df.withColumns({"_s": percent(F.col("_r"), F.lag("_r", 21).over(o)), "_v": F.stddev_samp("_d").over(w)})
    return df.withColumns({
        "momentum_regime": binned(F.col("_m"), [(-5, "strong_down"), (-1, "down"), (1, "flat"), (5, "up")], "strong_up"),
        "volatility_regime": binned(F.col("_v"), [(50, "calm"), (90, "normal")], "stressed"), "strength_regime": binned(F.col("_s"), [(-2, "weaker"), (2, "neutral")], "stronger"),
    }).drop("_m", "_r", "_d", "_s", "_v")


def calendar_position(df: DataFrame, *, keys: list[str], time: str) -> DataFrame:
    """Trading day in month and year, days left in each, and the event: the year's last 10 days, the month's last 5, its first 5, else middle."""
    month, year = F.trunc(time, "month"), F.trunc(time, "year")
    up = lambda p: F.row_number().over(Window.partitionBy(*keys, p).orderBy(time))
    down = lambda p: F.row_number().over(Window.partitionBy(*keys, p).orderBy(F.desc(time))) - 1
    df = df.withColumns({"day_in_month": up(month), "days_left_month": down(month), "day_in_year": up(year), "days_left_year": down(year)})
    event = F.when(F.col("days_left_year") < 10, "year_end").when(F.col("days_left_month") < 5, "month_end").when(F.col("day_in_month") <= 5, "month_start").otherwise("middle")
    return df.withColumn("calendar_event", event)


def target_labels(df: DataFrame, *, keys: list[str], time: str, horizons: int = 10) -> DataFrame:
    """The next opens, over rows that have both open and close."""
    o = ordered(keys, time)
    return df.where("open is not null and close is not null").withColumns({f"next_{h}_open": F.lead("open", h).over(o) for h in range(1, horizons + 1)})


def label_change_pct(df: DataFrame, *, horizons: int = 10) -> DataFrame:
    return df.withColumns({f"change_{h}": percent(F.col(f"next_{h}_open"), F.col("close")) for h in range(1, horizons + 1)})


def period_to_date(df: DataFrame, *, keys: list[str], time: str, col: str = "close") -> DataFrame:
    """Return since the first observed price of the month, quarter and year."""
    out = {}
    for name, unit in (("mtd", "month"), ("qtd", "quarter"), ("ytd", "year")):
        w = Window.partitionBy(*keys, F.trunc(time, unit)).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
        out[f"{name}_return"] = percent(F.col(col), F.first(col).over(w))
    return df.withColumns(out)


def ffill_causal(df: DataFrame, *, keys: list[str], time: str, cols: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def safe_features(df: DataFrame, *, blocked: list[str], unsafe: list[str]) -> list[str]:
    """Numeric columns that a model may see: no targets, no next-day columns, none of those barred."""
    import re

    from pyspark.sql.types import BooleanType, NumericType

    bad = {*blocked, *unsafe}
    return [f.name for f in df.schema if isinstance(f.dataType, (NumericType, BooleanType)) and f.name not in bad and not re.match(r"^next_\d+_", f.name)]
