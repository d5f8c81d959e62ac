"""Historical analogs: what followed in rows at least a year old that resemble today's, without a quadratic join.

For bucketed analogs (same month, same quarter, near day of the year) history rows and query rows are one union,
partitioned by series and bucket and ordered by time; a running aggregate up to the query row is the answer. The regime analog
sums over a box of earlier points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import ordered, percent, trailing
from . import boxes


def future_returns(df: DataFrame, *, keys: list[str], time: str, col: str = "close", horizons: tuple[int, ...] = (5, 7, 10, 21)) -> DataFrame:
    o = ordered(keys, time)
    return df.withColumns({f"future_{h}": percent(F.lead(col, h).over(o), F.col(col)) for h in horizons})


def _running(df: DataFrame, history: DataFrame, *, keys: list[str], time: str, bucket: Column, name: str, stats: dict[str, Column], cols: list[str]) -> DataFrame:
    """``history``: keys, _b, _d and ``cols``. Adds ``stats`` over the history rows of the same bucket up to a year before."""
    q = df.withColumns({"_b": bucket, "_d": F.add_months(time, -12), "_side": F.lit(1)})
    h = history.select(*keys, "_b", "_d", F.lit(0).alias("_side"), *(F.col(c).alias(f"_{c}") for c in cols))
    both = q.unionByName(h, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_b").orderBy("_d", "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumns({f"{name}_{n}": e.over(w) for n, e in stats.items()}).where("_side = 1").select(*df.columns, *(f"{name}_{n}" for n in stats))


def _stats(spec: dict[int, str]) -> dict[str, Column]:
    """Statistics of _future_h: m mean, s deviation, u share above zero, n count."""
    out: dict[str, Column] = {}
    for h, what in spec.items():
        x = F.col(f"_future_{h}")
        made = {"m": ("mean", F.avg(x)), "s": ("sd", F.stddev_samp(x)), "u": ("up", F.avg(F.when(x > 0, 1.0).when(x <= 0, 0.0))), "n": ("n", F.count(x))}
        out |= {f"{made[k][0]}_{h}": made[k][1] for k in what}
    return out


def same_month(df: DataFrame, *, keys: list[str], time: str) -> DataFrame:
    bucket = F.month(time)
    h = df.withColumns({"_b": bucket, "_d": F.col(time)})
    return _running(df, h, keys=keys, time=time, bucket=bucket, name="month", stats=_stats({5: "msun", 7: "mun", 21: "mun"}), cols=["future_5", "future_7", "future_21"])


def same_quarter(df: DataFrame, *, keys: list[str], time: str) -> DataFrame:
    bucket = F.quarter(time)
    h = df.withColumns({"_b": bucket, "_d": F.col(time)})
    return _running(df, h, keys=keys, time=time, bucket=bucket, name="quarter", stats=_stats({21: "mun"}), cols=["future_21"])


def day_of_year(df: DataFrame, *, keys: list[str], time: str, reach: int = 10) -> DataFrame:
    """Days of the year at most ``reach`` apart on a circle of 366: history rows stand in all the day buckets they are near."""
    near = F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda k: F.pmod(F.dayofyear(time) - 1 + k, F.lit(366)) + 1)
    h = df.withColumns({"_b": F.explode(near), "_d": F.col(time)})
    cols = ["future_5", "future_7", "future_10", "future_21"]
    return _running(df, h, keys=keys, time=time, bucket=F.dayofyear(time), name="day", stats=_stats({5: "msun", 7: "mun", 10: "mu", 21: "mun"}), cols=cols)


def regime(df: DataFrame, *, keys: list[str], time: str, col: str = "close", return_box: float = 2.0, vol_box: float = 0.35, block: int = boxes.BLOCK) -> DataFrame:
    """Rows whose 21-row return and volatility lie within the boxes of today's: sums over earlier points in a box, by :mod:`.boxes`."""
    o = ordered(keys, time)
    df = df.withColumns({"ret_21": percent(F.col(col), F.lag(col, 21).over(o)), "_d1": percent(F.col(col), F.lag(col).over(o))})
    df = df.withColumn("vol_21", F.stddev_samp("_d1").over(trailing(keys, time, 21))).drop("_d1")
    spec, measures = {5: "mun", 7: "mun", 10: "mu", 21: "mun"}, {}
    for h in spec:
        x = F.when(~F.isnan(f"future_{h}"), F.col(f"future_{h}"))
        measures |= {f"_s{h}": x, f"_c{h}": F.when(x.isNotNull(), 1.0), f"_p{h}": F.when(x > 0, 1.0)}
    found = boxes.earlier_in_box(df, keys=keys, time=time, until=F.add_months(time, -12), at=("ret_21", "vol_21"), reach=(return_box, vol_box), measures=measures, block=block)
    named = found.select(*(F.col(c).alias(f"_f_{c}") for c in [*keys, time]), *measures)
    same = F.lit(True)
    for c in [*keys, time]:
        same = same & F.col(c).eqNullSafe(F.col(f"_f_{c}"))
    out = df.join(named, same, "left")
    made: dict[str, Column] = {}
    for h, what in spec.items():
        s, n, p = (F.col(f"_{c}{h}") for c in "scp")
        value = {"m": ("mean", F.when(n > 0, s / n)), "u": ("up", F.when(n > 0, p / n)), "n": ("n", F.coalesce(F.round(n).cast("long"), F.lit(0)))}
        made |= {f"regime_{value[c][0]}_{h}": value[c][1] for c in what}
    return out.select(*(F.col(c) for c in df.columns if c not in made), *(e.alias(n) for n, e in made.items()))
