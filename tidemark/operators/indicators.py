"""Technical indicators of bars (open, high, low, close, volume), for many series at once.

Every operator has the shape ``op(df, *, keys, time, ...)`` and adds columns. Averages keep partial windows at a series' start unless
said otherwise. Columns of an input that have an output's name are replaced.
"""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rolling import ROW, rolling
from ..functions.windows import exponential, ordered, percent, ratio, trailing

SPANS = [10, 20, 50, 100, 200]


def sma_features(df: DataFrame, *, keys: list[str], time: str, col: str = "close", spans: list[int] = SPANS) -> DataFrame:
    """Simple averages, and the deviation over 20 rows."""
    out = {**{f"sma_{n}": ("mean", "_x", n) for n in spans}, "std_20": ("sd", "_x", 20)}
    return rolling(df.withColumn("_x", F.col(col).cast("double")).drop(*out), keys=keys, time=time, steps=[out]).drop("_x")


def ema_features(df: DataFrame, *, keys: list[str], time: str, col: str = "close", spans: list[int] = SPANS) -> DataFrame:
    """Finite exponential averages."""
    return exponential(df, keys=keys, time=time, averages={f"ema_{n}": (col, n) for n in spans})


def bollinger(df: DataFrame, *, keys: list[str], time: str, col: str = "close", n: int = 20, width: float = 2.0) -> DataFrame:
    w = trailing(keys, time, n)
    df = df.withColumns({"bb_middle": F.avg(col).over(w), "_sd": F.stddev_samp(col).over(w)})
    df = df.withColumns({"bb_upper": F.col("bb_middle") + width * F.col("_sd"), "bb_lower": F.col("bb_middle") - width * F.col("_sd")}).drop("_sd")
    span = F.col("bb_upper") - F.col("bb_lower")
    return df.withColumns({"bb_width": ratio(span, F.col("bb_middle")), "bb_percent": ratio(F.col(col) - F.col("bb_lower"), span)})


def rsi(df: DataFrame, *, keys: list[str], time: str, col: str = "close", n: int = 14) -> DataFrame:
    """Relative strength on simple averages; the first change counts as zero; from row n on; no loss gives 100."""
    w, o = trailing(keys, time, n), ordered(keys, time)
    df = df.withColumns({"_d": F.col(col) - F.lag(col).over(o), "_rn": F.row_number().over(o)})
    df = df.withColumns({"_g": F.greatest(F.col("_d"), F.lit(0.0)), "_l": F.greatest(-F.col("_d"), F.lit(0.0))})
    df = df.withColumns({"_ag": F.avg("_g").over(w), "_al": F.avg("_l").over(w)})
    value = F.when(F.col("_al") == 0, 100.0).otherwise(100 - 100 / (1 + F.col("_ag") / F.when(F.col("_al") != 0, F.col("_al"))))
    return df.withColumn(f"rsi_{n}", F.when(F.col("_rn") >= n, value)).drop("_d", "_rn", "_g", "_l", "_ag", "_al")


def macd(df: DataFrame, *, keys: list[str], time: str, col: str = "close", fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Difference of two finite exponential averages from row ``slow`` on, and its own average over the rows it has."""
    apart = lambda b: pc.if_else(pc.greater_equal(b.column(ROW), slow - 1), pc.subtract(b.column("_fast"), b.column("_slow")), None)
    steps = [{"_fast": ("ewm", "_x", fast), "_slow": ("ewm", "_x", slow)}, ("macd", apart), {"macd_signal": ("ewm", "macd", signal)}]
    df = rolling(df.withColumn("_x", F.col(col).cast("double")).drop("macd", "macd_signal"), keys=keys, time=time, steps=steps).drop("_x", "_fast", "_slow")
    return df.withColumn("macd_signal", F.when(F.col("macd").isNotNull(), F.col("macd_signal"))).withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def roc(df: DataFrame, *, keys: list[str], time: str, col: str = "close", n: int = 10) -> DataFrame:
    before = F.lag(col, n).over(ordered(keys, time))
    return df.withColumn(f"roc_{n}", F.when(before != 0, 100 * (F.col(col) - before) / before))


def typical_mean(df: DataFrame, *, keys: list[str], time: str, n: int = 20) -> DataFrame:
    """``_sma``: the mean of the last n typical prices ``_tp``, over rows that all have one or all lack one (keys tell which)."""
    return df.withColumn("_sma", F.avg("_tp").over(trailing(keys, time, n)))


def cci_from_mean(df: DataFrame, *, keys: list[str], time: str, n: int = 20) -> DataFrame:
    """The index from the typical price ``_tp`` and its mean ``_sma``."""
    df = df.withColumn("_near", F.collect_list("_tp").over(trailing(keys, time, n)))
    df = df.withColumn("_mad", F.aggregate("_near", F.lit(0.0), lambda a, x: a + F.abs(x - F.col("_sma"))) / F.when(F.size("_near") > 0, F.size("_near")))
    return df.withColumn(f"cci_{n}", F.when(F.col("_mad") > 0, (F.col("_tp") - F.col("_sma")) / (0.015 * F.col("_mad")))).drop("_tp", "_sma", "_near", "_mad")


def cci(df: DataFrame, *, keys: list[str], time: str, n: int = 20) -> DataFrame:
    """Commodity channel index. The mean is over n rows that have a price; the deviation around the row's own
    mean is over those of the n row numbers up to it, counted with the rows that lack one."""
    df = df.withColumn("_tp", (F.col("high") + F.col("low") + F.col("close")) / 3).withColumn("_priced", F.col("_tp").isNotNull())
    return cci_from_mean(typical_mean(df, keys=[*keys, "_priced"], time=time, n=n), keys=keys, time=time, n=n).drop("_priced")


def stochastic(df: DataFrame, *, keys: list[str], time: str, n: int = 14, smooth: int = 3) -> DataFrame:
    w = trailing(keys, time, n)
    df = df.withColumns({"_lo": F.min("low").over(w), "_hi": F.max("high").over(w)})
    df = df.withColumn("stoch_k", 100 * ratio(F.col("close") - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")
    return df.withColumn("stoch_d", F.avg("stoch_k").over(trailing(keys, time, smooth)))


def momentum_features(df: DataFrame, *, keys: list[str], time: str) -> DataFrame:
    """RSI, MACD, rate of change, CCI and stochastic in one chain over the same partitioning."""
    for op in (rsi, roc, cci, stochastic, macd):  # plain windows first, which share one shuffle
        df = op(df, keys=keys, time=time)
    return df


def adx(df: DataFrame, *, keys: list[str], time: str, n: int = 14) -> DataFrame:
    """True range, directional movement and the trend index on simple averages; a missing high or low is no movement."""
    w, o = trailing(keys, time, n), ordered(keys, time)
    df = df.withColumns({"_rn": F.row_number().over(o), "_pc": F.lag("close").over(o), "_up": F.col("high") - F.lag("high").over(o), "_dn": F.lag("low").over(o) - F.col("low")})
    df = df.withColumns({
        "_tr": F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("_pc")), F.abs(F.col("low") - F.col("_pc"))),
        "_pdm": F.when((F.col("_up") > F.col("_dn")) & (F.col("_up") > 0), F.col("_up")).otherwise(0.0), "_mdm": F.when((F.col("_dn") > F.col("_up")) & (F.col("_dn") > 0), F.col("_dn")).otherwise(0.0),
    })
    df = df.withColumns({f"atr_{n}": F.avg("_tr").over(w), "_p": F.avg("_pdm").over(w), "_m": F.avg("_mdm").over(w)})
    late = lambda x: F.when(F.col("_rn") >= n, x)
    df = df.withColumns({"plus_di": late(100 * ratio(F.col("_p"), F.col(f"atr_{n}"))), "minus_di": late(100 * ratio(F.col("_m"), F.col(f"atr_{n}")))})
    df = df.withColumn("dx", 100 * ratio(F.abs(F.col("plus_di") - F.col("minus_di")), F.col("plus_di") + F.col("minus_di")))
    return df.withColumn(f"adx_{n}", F.when(F.col("dx").isNotNull(), F.avg("dx").over(w))).drop("_rn", "_pc", "_up", "_dn", "_tr", "_pdm", "_mdm", "_p", "_m")


def zscore(df: DataFrame, *, keys: list[str], time: str, col: str = "close", spans: tuple[int, ...] = (20, 60)) -> DataFrame:
    """Deviations from the average of the last n rows, in standard deviations of theirs; null where those don't vary."""
    steps = [{f"_avg_{n}": ("mean", "_x", n) for n in spans} | {f"_sd_{n}": ("sd", "_x", n) for n in spans}]
    df = rolling(df.withColumn("_x", F.col(col).cast("double")), keys=keys, time=time, steps=steps)
    return df.withColumns({f"zscore_{n}": ratio(F.col("_x") - F.col(f"_avg_{n}"), F.col(f"_sd_{n}")) for n in spans}).drop("_x", *steps[0])


def sliding_windows(df: DataFrame, *, keys: list[str], time: str, spans: tuple[int, ...] = (5, 21, 63, 252)) -> DataFrame:
    """Average, extremes, deviation and change over each span; average volume over the two shortest."""
    o, out = ordered(keys, time), {f"volume_avg_{n}": ("mean", "_v", n) for n in spans[:2]}
    for n in spans:
        out |= {f"{name}_{n}": (kind, "_x", n) for name, kind in (("avg", "mean"), ("max", "max"), ("min", "min"), ("sd", "sd"))}
    df = df.withColumns({"_x": F.col("close").cast("double"), "_v": F.col("volume").cast("double"), **{f"change_{n}": percent(F.col("close"), F.lag("close", n).over(o)) for n in spans}})
    return rolling(df.drop(*out), keys=keys, time=time, steps=[out]).drop("_x", "_v")


def ewma_features(df: DataFrame, *, keys: list[str], time: str, spans: tuple[int, ...] = (5, 21, 63, 252)) -> DataFrame:
    """Finite exponential averages of price and volume, the price's distance to each, and which of two is above the other (1 or -1)."""
    df = exponential(df, keys=keys, time=time, averages={**{f"ewma_{n}": ("close", n) for n in spans}, **{f"volume_ewma_{n}": ("volume", n) for n in spans}})
    cross = {f"cross_{a}_{b}": F.when(F.col(f"ewma_{a}") > F.col(f"ewma_{b}"), 1).otherwise(-1) for a, b in zip(spans, spans[1:], strict=False)}
    return df.withColumns({**{f"distance_{n}": percent(F.col("close"), F.col(f"ewma_{n}")) for n in spans}, **cross})
