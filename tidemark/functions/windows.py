"""Keyed windows. Every window is partitioned by the series, so series spread over the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .rolling import rolling


def ordered(keys: list[str], time: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(time)


def trailing(keys: list[str], time: str, n: int) -> WindowSpec:
    """The current row and the n - 1 before it; shorter at a series' start."""
    return ordered(keys, time).rowsBetween(-(n - 1), 0)


def exponential(df: DataFrame, *, keys: list[str], time: str, averages: dict[str, tuple[str, int]]) -> DataFrame:
    """Add finite exponential averages: ``averages`` maps a new column to (column, n). Weights are those of span n over the last n rows, renormalised over the non-null values; a null still ages the
    values before it, and a window without values gives null. A value that isn't finite gives NaN in the windows that hold it, and leaves others alone."""
    first = {c: f"_x{i}" for i, c in enumerate(dict.fromkeys(c for c, _ in averages.values()))}
    given = [c for c in df.columns if c not in averages]
    df = df.withColumns({x: F.col(c).cast("double") for c, x in first.items()}).drop(*averages)
    return rolling(df, keys=keys, time=time, steps=[{out: ("ewm", first[c], n) for out, (c, n) in averages.items()}]).select(*given, *averages)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null unless b is above zero."""
    return F.when(b > 0, a / b)


def percent(a: Column, b: Column) -> Column:
    """100 * (a / b - 1), null unless b is above zero."""
    return F.when(b > 0, 100 * (a / b - 1))


#: Added before rounding: averages of cents often lie half way between two decimals, where the order of a sum decides.
NUDGE = 3.3e-9


def rounded(x: Column, places: int = 4) -> Column:
    """Rounded for comparison with another engine, without a negative zero."""
    return F.round(x + NUDGE, places) + F.lit(0.0)
