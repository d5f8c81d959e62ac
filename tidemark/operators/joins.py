"""Joins and keyed merges: priority merges, as-of and interval lookups, bounded fills, upserts.

None of them plans to a nested loop: as-of and interval lookups are a union and a running last value over one
partitioning by the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def full_outer_priority(first: DataFrame, second: DataFrame, *, on: list[str], cols: dict[str, str]) -> DataFrame:
    """All keys of both; ``cols`` maps each column of the first to the column of the second that stands in for it."""
    b = second.select(*on, *(F.col(s).alias(f"_{i}") for i, s in enumerate(cols.values())))
    df = first.join(b, on, "full_outer")
    return df.withColumns({c: F.coalesce(F.col(c), F.col(f"_{i}")) for i, c in enumerate(cols)}).drop(*(f"_{i}" for i in range(len(cols))))


def tail_fill_anti(primary: DataFrame, fallback: DataFrame, *, on: list[str]) -> DataFrame:
    """The primary rows, and the fallback's for keys that the primary lacks."""
    return primary.unionByName(fallback.join(primary.select(*on), on, "left_anti").select(*primary.columns))


def series_fallback(primary: DataFrame, fallback: DataFrame, *, series: str) -> DataFrame:
    """The fallback's whole series where the primary has no row of it."""
    return primary.unionByName(fallback.join(primary.select(series).distinct(), series, "left_anti").select(*primary.columns))


def asof(left: DataFrame, right: DataFrame, *, keys: list[str], left_time: str, right_time: str, cols: list[str], strict: bool = True) -> DataFrame:
    """Add to each left row the ``cols`` of the last right row before its time (or at it, if not ``strict``), null where there is none.
    Both sides are sorted once by key and time; a right row counts after a left one of the same time if strict."""
    value = F.struct(*cols)
    a = left.withColumns({"_t": F.col(left_time), "_side": F.lit(1), "_v": F.lit(None)})
    b = right.select(*keys, F.col(right_time).alias("_t"), F.lit(2 if strict else 0).alias("_side"), value.alias("_v"))
    both = a.drop("_v").unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_side = 1").select(*left.columns, "_v.*")


def with_intervals(df: DataFrame, *, keys: list[str], start: str, end: str) -> DataFrame:
    """The half-open interval for which each row is the latest; open-ended at the last."""
    return df.withColumn(end, F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))


def interval_join(left: DataFrame, right: DataFrame, *, keys: list[str], time: str, start: str, cols: list[str]) -> DataFrame:
    """Left rows with the right row whose interval [start, next start) holds their time. A series' intervals are disjoint, so this is as-of."""
    return asof(left, right, keys=keys, left_time=time, right_time=start, cols=cols, strict=False)


def ffill_bounded(df: DataFrame, *, keys: list[str], time: str, cols: list[str], max_gap_days: int, when: Column | None = None) -> DataFrame:
    """Fill nulls with the last value of the ``max_gap_days`` calendar days before, on rows where ``when`` holds. Only values that were there
    count, not filled ones."""
    if max_gap_days < 0:
        raise ValueError("max_gap_days must not be negative")
    day = F.datediff(F.col(time), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy(day).rangeBetween(-max_gap_days, -1)
    ok = F.lit(True) if when is None else when
    return df.withColumns({c: F.when(F.col(c).isNull() & ok, F.last(c, ignorenulls=True).over(w)).otherwise(F.col(c)) for c in cols}) if max_gap_days else df


def monthly_to_daily(df: DataFrame, *, time: str) -> DataFrame:
    """Each month's row for every day of its month."""
    days = F.sequence(F.trunc(time, "month"), F.last_day(time))
    return df.withColumn("_d", F.explode(days)).drop(time).withColumnRenamed("_d", time)


def pivot_series(df: DataFrame, *, time: str, name: str, value: str, names: dict[str, str]) -> DataFrame:
    """One column for each named series, one row for each time."""
    return df.groupBy(time).agg(*(F.max(F.when(F.col(name) == k, F.col(value))).alias(c) for k, c in names.items()))


def unpivot_metrics(df: DataFrame, *, ids: list[str], metrics: list[str]) -> DataFrame:
    return df.unpivot(ids, metrics, "metric", "value")


def dedupe_latest(df: DataFrame, *, on: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by ``order``."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*on).orderBy(*order))).where("_rn = 1").drop("_rn")


def upsert_full(base: DataFrame, new: DataFrame, *, on: list[str]) -> DataFrame:
    """New rows replace the base's of the same key."""
    return base.join(new.select(*on), on, "left_anti").select(*base.columns).unionByName(new)


def upsert_subset(base: DataFrame, new: DataFrame, *, on: list[str], cols: list[str]) -> DataFrame:
    """New keys are inserted with ``cols`` alone; on old keys ``cols`` are overwritten, also by nulls."""
    n = new.select(*on, F.lit(True).alias("_new"), *(F.col(c).alias(f"_{c}") for c in cols))
    df = base.join(n, on, "full_outer")
    return df.withColumns({c: F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)) for c in cols}).select(*base.columns)


def upsert_ignore(base: DataFrame, new: DataFrame, *, on: list[str]) -> DataFrame:
    """New rows only for keys that the base lacks."""
    return base.unionByName(new.join(base.select(*on), on, "left_anti").select(*base.columns))


def one_to_one(left: DataFrame, right: DataFrame, *, on: list[str]) -> DataFrame:
    """Inner join that fails unless every left row has exactly one partner."""
    if right.groupBy(*on).count().where("count > 1").limit(1).count():
        raise ValueError("keys of the right side are not unique")
    if left.join(right, on, "left_anti").limit(1).count():
        raise ValueError("rows of the left side have no partner")
    return left.join(right, on)
