"""Statistics of features and targets: summaries, correlations, drift, histograms, hashes."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import CHUNK_ROWS
from . import quantiles


def _summed(df: DataFrame, by: list[str], value: str, stats: list, shares: list[float], out: list[str], large: int) -> DataFrame:
    """``stats`` and exact quantiles of each group: in one aggregate where no group is above ``large`` rows, else beside each other."""
    if not quantiles.any_large(df, by, large):
        q = F.percentile(F.col(value), F.array(*map(F.lit, shares))).alias("_q")
        return df.groupBy(*by).agg(*stats, q).withColumns({c: F.col("_q")[i] for i, c in enumerate(out)}).drop("_q")
    q = quantiles.quantiles(df, by=by, value=value, shares=shares, out=out, large=large).select(*(F.col(c).alias(f"_q_{c}") for c in by), *out)
    same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_q_{c}")), by, F.lit(True))
    return df.groupBy(*by).agg(*stats).join(q, same, "left").drop(*(f"_q_{c}" for c in by))


def group_summary(df: DataFrame, *, by: list[str], value: str, large: int = quantiles.LARGE) -> DataFrame:
    """Count, mean, median, deviation, share above zero and t of each group. Medians of groups above ``large`` values are selected in ranges."""
    x = F.col(value)
    df = df.where(x.isNotNull())
    stats = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), F.avg(F.when(x > 0, 1.0).otherwise(0.0)).alias("up_rate")]
    stats = _summed(df, by, value, stats, [0.5], ["median"], large)
    return stats.withColumn("t_stat", F.when(F.col("sd") > 0, F.col("mean") / (F.col("sd") / F.sqrt("n")))).select(*by, "n", "mean", "median", "sd", "up_rate", "t_stat")


def top_abs(df: DataFrame, *, col: str, k: int, ties: list[str]) -> DataFrame:
    return df.where(F.col(col).isNotNull()).orderBy(F.abs(F.col(col)).desc(), *ties).limit(k)


def seasonal_consistency(df: DataFrame, *, keys: list[str], time: str, value: str) -> DataFrame:
    """Mean by year and month, and how alike the years of each month are."""
    one = df.where(F.col(value).isNotNull()).groupBy(*keys, F.year(time).alias("year"), F.month(time).alias("month")).agg(F.avg(value).alias("m"))
    return one.groupBy(*keys, "month").agg(F.count("*").alias("years"), F.avg("m").alias("mean"), F.median("m").alias("median"), F.avg(F.when(F.col("m") > 0, 1.0).otherwise(0.0)).alias("positive_rate"))


PERCENTS = [1, 5, 25, 50, 75, 95, 99]


def describe(df: DataFrame, *, by: list[str], value: str, large: int = quantiles.LARGE) -> DataFrame:
    """Count, moments, extremes and exact percentiles; those of groups above ``large`` values are selected in ranges."""
    x = F.col(value)
    stats = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), F.min(x).alias("min"), F.max(x).alias("max")]
    return _summed(df, by, value, stats, [p / 100 for p in PERCENTS], [f"p{p}" for p in PERCENTS], large)


def corr_matrix(df: DataFrame, *, cols: list[str]) -> DataFrame:
    """(a, b, corr) of every pair a < b over rows that have both; all pairs in one aggregate."""
    pairs = [*combinations(sorted(cols), 2)]
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    one = df.agg(*(F.corr(F.when(both(a, b), F.col(a)), F.when(both(a, b), F.col(b))).alias(f"{a}|{b}") for a, b in pairs))
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "corr")


#: Columns up to which pairs are one aggregate expression each; wider tables go through blocks of co-moments.
FEW_COLUMNS = 12


def wide_corr_matrix(df: DataFrame, *, cols: list[str]) -> DataFrame:
    """(a, b, corr) of every pair a < b over rows that have both, for tables of many columns. Each task adds up, for all pairs at once, the counts, sums and products of its Arrow batches as
    products of matrices with their null masks; columns are centred by their means first, so that little is lost. A column's rows of these matrices are then summed by column. NaN counts as missing; null
    where fewer than two rows have both or one doesn't vary."""
    cols = sorted(cols)
    p = len(cols)
    values = df.select(*(F.col(c).cast("double").alias(c) for c in cols))
    means = values.agg(*(F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in cols)).first()
    centre = np.array([means[c] or 0.0 for c in cols])

    def moments(batches):
        total = np.zeros((4, p, p))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(float) - centre
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            total += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        yield pa.RecordBatch.from_arrays([pa.array(range(p), pa.int32()), pa.array([total[:, i].tobytes() for i in range(p)], pa.binary())], ["i", "m"])

    def summed(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(m).reshape(4, p) for m in rows.column("m").to_pylist())
        return pa.table({"i": rows.column("i")[:1], "m": pa.array([total.tobytes()], pa.binary())})

    held = {r["i"]: np.frombuffer(r["m"]).reshape(4, p) for r in values.mapInArrow(moments, "i int, m binary").groupBy("i").applyInArrow(summed, "i int, m binary").collect()}  # a row for each column
    out = []
    for i, j in combinations(range(p), 2):
        n, x, xx, xy = held[i][:, j] if held else (0, 0, 0, 0)
        y, yy = held[j][1:3, i] if held else (0, 0)
        a, b = (xx - x * x / n, yy - y * y / n) if n > 1 else (0.0, 0.0)
        out.append((cols[i], cols[j], float((xy - x * y / n) / np.sqrt(a) / np.sqrt(b)) if a > 0 and b > 0 else None))
    return df.sparkSession.createDataFrame(out, "a string, b string, corr double")


def redundant_pairs(df: DataFrame, *, cols: list[str], least: float = 0.98) -> DataFrame:
    """Pairs of columns that say nearly the same, strongest first."""
    matrix = corr_matrix if len(cols) <= FEW_COLUMNS else wide_corr_matrix
    return matrix(df, cols=cols).where(F.abs("corr") >= least).orderBy(F.abs("corr").desc(), "a", "b")


def spearman_target(df: DataFrame, *, keys: list[str], cols: list[str], target: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """Rank correlation of each column with the target within each series, over rows that have both; ties have their mean rank. A series' ranks are found by ranges of ``rows`` distinct values."""
    long = df.select(*keys, F.col(target).alias("_t"), *cols).unpivot([*keys, "_t"], cols, "feature", "_x")
    return quantiles.spearman(long, by=[*keys, "feature"], a="_x", b="_t", rows=rows)


def drift_smd(df: DataFrame, *, keys: list[str], time: str, cols: list[str], share: float = 0.8) -> DataFrame:
    """|mean of the last rows - mean of the first| / deviation of the first, by column."""
    w = Window.partitionBy(*keys)
    df = df.withColumn("_late", F.row_number().over(w.orderBy(time)) > F.floor(F.count("*").over(w) * share))
    long = df.select(*keys, "_late", *cols).unpivot([*keys, "_late"], cols, "feature", "_x")
    first, last = F.when(~F.col("_late"), F.col("_x")), F.when(F.col("_late"), F.col("_x"))
    out = long.groupBy(*keys, "feature").agg(F.avg(first).alias("m0"), F.avg(last).alias("m1"), F.stddev_samp(first).alias("s0"))
    return out.withColumn("drift", F.when(F.col("s0") > 0, F.abs(F.col("m1") - F.col("m0")) / F.col("s0")))


def data_quality_summary(df: DataFrame, *, by: list[str], time: str, value: str) -> DataFrame:
    x = F.col(value)
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(x.isNull()).alias("missing"), F.count_if(x > 50000).alias("above"), F.countDistinct(time).alias("dates"), F.min(time).alias("first_date"), F.max(time).alias("last_date"), F.avg(F.when(x > 50000, x)).alias("mean_above"))


def return_histogram(df: DataFrame, *, keys: list[str], value: str, bins: int = 50) -> DataFrame:
    """Counts in bins of equal width between each series' extremes; the largest value is in the last bin."""
    df = df.where(F.col(value).isNotNull())
    ends = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    df = df.join(ends, keys)
    at = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col(value) - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins)), F.lit(bins - 1))).otherwise(0)
    return df.groupBy(*keys, at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def content_hash(df: DataFrame, *, by: list[str], cols: list[str]) -> DataFrame:
    """A hash of the rows' content that doesn't depend on their order: the sum of the first 60 bits of each row's MD5. Columns are taken as text, null as "-";
    rows that come twice count twice."""
    text = F.concat_ws("|", *(F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")) for c in cols))
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.sum(h).cast("string").alias("hash"), F.count("*").alias("n"))


def latest_row(df: DataFrame, *, keys: list[str], time: str, cols: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(F.struct(time, *cols), time).alias("x")).select(*keys, "x.*")


def latest_values(df: DataFrame, *, keys: list[str], time: str, prefix: str) -> DataFrame:
    """The last row of each series, turned: one row for each column of the prefix."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    one = latest_row(df, keys=keys, time=time, cols=cols)
    return one.select(*keys, time, *(F.col(c).cast("double").alias(c) for c in cols)).unpivot([*keys, time], cols, "name", "value")
