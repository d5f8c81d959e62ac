"""Data quality: flags, gates, constraint and freshness reports, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.windows import trailing


def outlier_flag(df: DataFrame, *, keys: list[str], time: str, col: str, n: int = 252, limit: float = 5.0, flag: str = "is_outlier") -> DataFrame:
    """Flag rows further than ``limit`` deviations from their trailing mean, the row itself included; a flag that is set stays."""
    w = trailing(keys, time, n)
    sd = F.stddev_samp(col).over(w)
    z = F.abs(F.col(col) - F.avg(col).over(w)) / F.when(sd > 0, sd)
    before = F.coalesce(F.col(flag), F.lit(False)) if flag in df.columns else F.lit(False)
    return df.withColumn("_far", F.coalesce(z > limit, F.lit(False))).withColumn(flag, before | F.col("_far")).drop("_far")


def refresh_gate(counts: DataFrame, *, strict: bool = False) -> DataFrame:
    """(name, rows, minimum) with ``ok``. With ``strict``, raise with every failure at once."""
    df = counts.withColumn("ok", F.col("rows") >= F.col("minimum"))
    if strict and (bad := df.where("not ok").orderBy("name").collect()):
        raise ValueError("; ".join(f"{x['name']}: {x['rows']} of {x['minimum']} rows" for x in bad))
    return df


def key_uniqueness(df: DataFrame, *, on: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1")


def constraint_report(df: DataFrame, *, on: list[str], parent: DataFrame, parent_key: str, child_key: str, domain: dict[str, list[str]]) -> DataFrame:
    """Violations by constraint: repeated keys, keys without a parent, values outside of their domain."""
    parts = [key_uniqueness(df, on=on).agg(F.count("*").alias("n")).select(F.lit("unique").alias("rule"), "n")]
    parts.append(df.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti").agg(F.count("*").alias("n")).select(F.lit("parent").alias("rule"), "n"))
    parts += [df.agg(F.count_if(~F.col(c).isin(v)).alias("n")).select(F.lit(f"domain_{c}").alias("rule"), "n") for c, v in domain.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness_report(tables: dict[str, tuple[DataFrame | None, str]], *, as_of: str, limit_days: int, fallback: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Last date and age of each table, and whether it is ok, stale or empty. A table that is empty or couldn't be read (None) and has rows in
    ``fallback`` is shown with those, as fallback; one that couldn't be read and has none is an error."""
    spark = next(df for df, _ in [*tables.values(), *(fallback or {}).values()] if df is not None).sparkSession
    out = None
    for name, (df, time) in tables.items():
        last = spark.range(1).select(F.lit(None).cast("date").alias("own")) if df is None else df.agg(F.max(time).cast("date").alias("own"))
        if name in (fallback or {}):
            other, at = fallback[name]
            last = last.withColumn("other", other.agg(F.max(at).cast("date")).scalar())
        else:
            last = last.withColumn("other", F.lit(None).cast("date"))
        one = last.select(F.lit(name).alias("name"), F.coalesce("own", "other").alias("last_date"), F.lit(df is not None).alias("_read"), F.col("own").isNotNull().alias("_own"))
        out = one if out is None else out.unionByName(one)
    age = F.datediff(F.lit(as_of).cast("date"), F.col("last_date"))
    state = F.when(F.col("last_date").isNull(), F.when(F.col("_read"), "empty").otherwise("error")).when(~F.col("_own"), "fallback").when(age > limit_days, "stale").otherwise("ok")
    return out.withColumns({"age_days": age, "status": state}).drop("_read", "_own")


def table_status(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Row count and OK, EMPTY or NOT FOUND; a table that is absent counts -1."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    out = spark.createDataFrame([(n, -1) for n, df in tables.items() if df is None], "name string, n long")
    for name, df in tables.items():
        if df is not None:
            out = out.unionByName(df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n"))
    return out.withColumn("status", F.when(F.col("n") < 0, "NOT FOUND").when(F.col("n") == 0, "EMPTY").otherwise("OK"))


def missing_profile(df: DataFrame, *, cols: list[str]) -> DataFrame:
    """Nulls and their percentage of each column that has any; one pass over the rows."""
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    return one.unpivot(["_n"], cols, "column", "missing").where("missing > 0").select("column", "missing", F.round(100 * F.col("missing") / F.col("_n"), 2).alias("percent"))


def feature_coverage(df: DataFrame, *, cols: list[str], least: float = 0.8) -> DataFrame:
    """Share of rows that have each column, and whether it is enough."""
    one = df.agg(*(F.avg(F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0)).alias(c) for c in cols))
    return one.unpivot([], cols, "column", "coverage").withColumn("selected", F.col("coverage") >= least)
