"""The window operators, as-of and interval lookups and fills for series too long for one task.

Results equal those of :mod:`.indicators`, :mod:`.projections` and :mod:`.joins`; each series is cut into chunks (:mod:`..functions.chunks`). Columns
that start with an underscore are the library's own.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import CHUNK_ROWS, in_chunks, running_last
from . import indicators, projections


def _deepest(spans) -> int:
    return max(spans) - 1


#: How many rows before a row each operator looks at with its default spans: spans of nested windows add up, a change takes one row more.
REACH = {
    "sma_features": _deepest(indicators.SPANS), "ema_features": 2 * _deepest(indicators.SPANS) + 1, "bollinger": 19, "rsi": 14, "macd": 2 * 26 + 2 * 9, "roc": 10, "stochastic": 13 + 2, "adx": 1 + 13 + 13,
    "zscore": 59, "sliding_windows": 252, "ewma_features": 2 * 252, "bar_shape": 1, "log_bar_features": 1, "log_return_lags": 253, "rolling_return_stats": 252, "volume_zscore": 251,
}


def windows(df: DataFrame, name: str, *, keys: list[str], time: str, rows: int = CHUNK_ROWS, reach: int | None = None, **spans) -> DataFrame:
    """The operator ``name`` of :data:`REACH` over chunks of ``rows`` rows. With spans other than the defaults, ``reach`` tells how far back it looks."""
    if spans and reach is None:
        raise ValueError("reach must be given with spans")
    op = getattr(indicators, name, None) or getattr(projections, name)
    return in_chunks(df, partial(op, **spans), keys=keys, time=time, before=REACH[name] if reach is None else reach, rows=rows)


def cci(df: DataFrame, *, keys: list[str], time: str, n: int = 20, rows: int = CHUNK_ROWS) -> DataFrame:
    """:func:`.indicators.cci`. Its mean is over rows that have a price, however far apart, so those are cut into chunks by themselves first; the deviations then
    need the n rows before only."""
    df = df.withColumns({"_tp": (F.col("high") + F.col("low") + F.col("close")) / 3, "_priced": (F.col("high") + F.col("low") + F.col("close")).isNotNull()})
    df = in_chunks(df, partial(indicators.typical_mean, n=n), keys=[*keys, "_priced"], time=time, before=n - 1, rows=rows)
    return in_chunks(df, partial(indicators.cci_from_mean, n=n), keys=keys, time=time, before=n - 1, rows=rows).drop("_priced")


def target_labels(df: DataFrame, *, keys: list[str], time: str, horizons: int = 10, rows: int = CHUNK_ROWS) -> DataFrame:
    """The next opens; chunks get the first rows of the one behind."""
    df = df.where("open is not null and close is not null")
    return in_chunks(df, partial(projections.target_labels, horizons=horizons), keys=keys, time=time, after=horizons, rows=rows)


def ffill_causal(df: DataFrame, *, keys: list[str], time: str, cols: list[str], rows: int = CHUNK_ROWS) -> DataFrame:
    """Unbounded fill; a chunk's last values are passed on to those behind."""
    last = running_last(df, keys=keys, time=time, cols=cols, rows=rows)
    return last.select(*(F.col(f"_last_{c}").alias(c) if c in cols else F.col(c) for c in df.columns))


def ffill_bounded(df: DataFrame, *, keys: list[str], time: str, cols: list[str], max_gap_days: int, when: Column | None = None, rows: int = CHUNK_ROWS) -> DataFrame:
    """Fill nulls with the last value of the ``max_gap_days`` calendar days before, on rows where ``when`` holds. The last value and its day are carried, and the day decides."""
    if max_gap_days < 0:
        raise ValueError("max_gap_days must not be negative")
    if not max_gap_days:
        return df
    ok = F.lit(True) if when is None else when
    held = df.withColumns({"_day": F.datediff(F.col(time), F.lit("1970-01-01").cast("date")), "_ok": ok})
    held = held.withColumns({f"_v{i}": F.when(F.col(c).isNotNull(), F.struct(F.col("_day").alias("day"), F.col(c).alias("x"))) for i, c in enumerate(cols)})
    last = running_last(held, keys=keys, time="_day", cols=[f"_v{i}" for i in range(len(cols))], rows=rows, strict=True)
    filled = {c: F.when(F.col(c).isNull() & F.col("_ok") & (F.col(f"_last__v{i}.day") >= F.col("_day") - max_gap_days), F.col(f"_last__v{i}.x")).otherwise(F.col(c)) for i, c in enumerate(cols)}
    return last.withColumns(filled).select(*df.columns)


def asof(left: DataFrame, right: DataFrame, *, keys: list[str], left_time: str, right_time: str, cols: list[str], strict: bool = True, rows: int = CHUNK_ROWS) -> DataFrame:
    """:func:`.joins.asof` with both sides cut into common ranges of (keys, time)."""
    a = left.withColumns({"_t": F.col(left_time), "_side": F.lit(1)})
    b = right.select(*keys, F.col(right_time).alias("_t"), F.lit(2 if strict else 0).alias("_side"), F.struct(*cols).alias("_v"))
    both = a.unionByName(b, allowMissingColumns=True)
    return running_last(both, keys=keys, time=["_t", "_side"], cols=["_v"], rows=rows).where("_side = 1").select(*left.columns, "_last__v.*")


def interval_join(left: DataFrame, right: DataFrame, *, keys: list[str], time: str, start: str, cols: list[str], rows: int = CHUNK_ROWS) -> DataFrame:
    """Left rows with the right row whose interval [start, next start) holds their time."""
    return asof(left, right, keys=keys, left_time=time, right_time=start, cols=cols, strict=False, rows=rows)
