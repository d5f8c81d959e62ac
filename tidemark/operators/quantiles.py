"""Exact quantiles and rank correlations of groups of any size.

Quantiles: a mergeable sketch gives the borders of 512 ranges of each large group. One pass counts how many values lie before the ranges that hold a wanted
rank, and only the values within those few are ordered, equal ones counted once; where a range has too many for one task, they are dealt by ranges that pass their counts on.
Nothing depends on how good the sketch is but the work: a rank outside of its range is looked for in all values.

Ranks: equal values are counted first. The distinct values are dealt by ranges, each range passes its count on, and a value's average
rank follows from what is before it and how many are equal to it. Groups must be named by one column at least.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunks import CHUNK_ROWS, passed_on, ranged
from ..functions.storage import stored

#: Ranges that a large group is cut into, and the sketch's accuracy (its rank error is 1 / accuracy).
RANGES, ACCURACY = 512, 20_000
#: Rows of a group from which its quantiles are selected in ranges, and values that one task puts into order.
LARGE, FEW = 100_000, 500_000
#: Groups known to be large, at most, before they are joined by key and no longer sent to every task.
SENT_GROUPS = 10_000


def _equal(by: list[str], other: str = "_g_") -> Column:
    return reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"{other}{c}")), by, F.lit(True))


def _beside(df: DataFrame, small: DataFrame, by: list[str], rows: int) -> DataFrame:
    """``df`` with its group's row of ``small`` (columns of ``by`` named _g_...). Few groups go to all tasks; of many, each is copied for several parts of its rows, so that a hot one isn't one task's."""
    if rows <= SENT_GROUPS:
        return df.join(F.broadcast(small), _equal(by))
    salts = 32
    dealt = df.withColumn("_salt", F.floor(F.rand(1) * salts).cast("int"))
    return dealt.join(small.withColumn("_g_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), _equal(by) & (F.col("_salt") == F.col("_g_salt"))).drop("_salt", "_g_salt")


def values_at(df: DataFrame, wanted: DataFrame, *, by: list[str], value: str, few: int = FEW, sketched: bool = True) -> DataFrame:
    """(by, _k, x): the value of rank ``_k`` (from 0) of each group for each row (by, _k) of ``wanted``, of which a group has a few. ``value`` must be a double and not null. Unless ``sketched``, a
    rank's range is its whole group."""
    x, own = F.col(value), [*by, "_k"]
    shares = [i / RANGES for i in range(RANGES + 1)]
    borders = F.percentile_approx(x, shares, ACCURACY) if sketched else F.lit(None).cast("array<double>")
    sizes = stored(df.groupBy(*by).agg(F.count(x).alias("_n"), borders.alias("_b"), F.min(x).alias("_min"), F.max(x).alias("_max")))
    named = wanted.select(*(F.col(c).alias(f"_g_{c}") for c in by), "_k")
    at = F.floor(F.col("_k") * RANGES / F.greatest(F.col("_n") - 1, F.lit(1))).cast("int")  # the range of the rank; one more on either side is taken
    low, high = F.get("_b", at - 1), F.get("_b", at + 2)
    targets = sizes.join(named, _equal(by)).where("_k >= 0 and _k < _n").select(*(F.col(c).alias(f"_g_{c}") for c in by), "_k", F.coalesce(low, "_min").alias("lo"), F.coalesce(high, "_max").alias("hi"))
    packed = stored(targets.groupBy(*(f"_g_{c}" for c in by)).agg(F.collect_list(F.struct("_k", "lo", "hi")).alias("_w")))
    near = _beside(df.select(*by, x.alias("_x")), packed, by, packed.count()).select(*by, "_x", F.explode(F.filter("_w", lambda w: F.col("_x") <= w["hi"])).alias("w"))
    # Of values before a range only the number matters: they count as one null.
    counted = stored(near.groupBy(*by, F.col("w._k").alias("_k"), F.when(F.col("_x") >= F.col("w.lo"), F.col("_x")).alias("_x")).agg(F.count("*").alias("_c")))
    size = counted.groupBy(*own).agg(F.sum("_c").alias("upto"), F.coalesce(F.sum(F.when(F.col("_x").isNull(), F.col("_c"))), F.lit(0)).alias("before"), F.count("_x").alias("distinct"))
    size = stored(size.withColumn("missed", (F.col("_k") < F.col("before")) | (F.col("_k") >= F.col("upto"))))
    of = lambda which: size.where(which).select(*(F.col(c).alias(f"_g_{c}") for c in own), "before")
    inside = lambda which: counted.where("_x is not null").join(of(which), _equal(own)).select(*own, "_x", "_c", "before")
    picked = lambda d: d.where((F.col("_k") < F.col("_end")) & (F.col("_k") >= F.col("_end") - F.col("_c"))).select(*own, F.col("_x").alias("x"))
    w = Window.partitionBy(*own).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    out = picked(inside(~F.col("missed") & (F.col("distinct") <= few)).withColumn("_end", F.col("before") + F.sum("_c").over(w)))
    if size.where(~F.col("missed") & (F.col("distinct") > few)).limit(1).count():
        wide = running_counts(inside(~F.col("missed") & (F.col("distinct") > few)), by=own, value="_x", count="_c", rows=few)
        out = out.unionByName(picked(wide.withColumn("_end", F.col("_end") + F.col("before"))))
    if sketched and size.where("missed").limit(1).count():
        out = out.unionByName(values_at(df, size.where("missed").select(*own), by=by, value=value, few=few, sketched=False))
    return out


def running_counts(counts: DataFrame, *, by: list[str], value: str, count: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``counts``, one row for each distinct value of a group, with ``_end``: how many rows have the value or a smaller one. Work and memory of a task are those of a range of distinct values."""
    parts, _ = ranged(counts, keys=by, time=value, rows=rows)
    before = passed_on(parts, own={"_n": F.sum(count)}, carry={"_before": lambda w: F.coalesce(F.sum("_n").over(w), F.lit(0))})
    w = Window.partitionBy("_series", "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.withColumn("_own", F.sum(count).over(w)).join(before, ["_series", "_range"])
    return local.select(*counts.columns, (F.col("_before") + F.col("_own")).alias("_end"))


def any_large(df: DataFrame, by: list[str], large: int) -> bool:
    """Whether a group has more than ``large`` rows. Only the group's columns are computed for this."""
    return bool(df.groupBy(*by).count().where(F.col("count") > large).limit(1).count())


def quantiles(df: DataFrame, *, by: list[str], value: str, shares: list[float], out: list[str], large: int = LARGE, few: int = FEW) -> DataFrame:
    """(by, out...): the exact quantiles of each group, between two values in proportion, as ``percentile`` gives them. Groups of up to ``large`` values take one task each; larger ones are never
    in one place. Null values don't count; a group without values has null quantiles."""
    df = df.select(*by, F.col(value).cast("double").alias("_v"))
    names = [f"_q{i}" for i in range(len(shares))]
    plain = lambda d: d.groupBy(*by).agg(F.percentile("_v", F.array(*map(F.lit, shares))).alias("_q")).select(*by, *(F.col("_q")[i].alias(c) for i, c in enumerate(names)))
    if any_large(df, by, large):
        big = stored(df.groupBy(*by).agg(F.count("_v").alias("_n")).where(F.col("_n") > large)).select(*(F.col(c).alias(f"_g_{c}") for c in by), "_n")
        many = big.count()
    else:
        many = 0
    if not many:
        return plain(df).select(*by, *(F.col(c).alias(o) for c, o in zip(names, out, strict=True)))
    small = df.join(F.broadcast(big), _equal(by), "left_anti") if many <= SENT_GROUPS else df.join(big, _equal(by), "left_anti")
    rows = _beside(df.where("_v is not null"), big.drop("_n"), by, many).select(*by, "_v")
    place = lambda s: (F.col("_n") - 1) * F.lit(s)
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(place(s)).cast("long"), F.ceil(place(s)).cast("long")) for s in shares))))
    own = big.select(*(F.col(f"_g_{c}").alias(c) for c in by), "_n")
    found = values_at(rows, own.select(*by, F.explode(ranks).alias("_k")), by=by, value="_v", few=few)
    found = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_k", "x"))).alias("_m")).select(*(F.col(c).alias(f"_g_{c}") for c in by), "_m")
    low, high = lambda s: F.col("_m")[F.floor(place(s)).cast("long")], lambda s: F.col("_m")[F.ceil(place(s)).cast("long")]
    wide = own.join(found, _equal(by)).select(*by, *((low(s) + (high(s) - low(s)) * (place(s) - F.floor(place(s)))).alias(c) for s, c in zip(shares, names, strict=True)))
    return plain(small).unionByName(wide).select(*by, *(F.col(c).alias(o) for c, o in zip(names, out, strict=True)))


def average_ranks(counts: DataFrame, *, by: list[str], value: str, count: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``counts``, one row for each distinct value of a group, with ``rank``: the average rank, from 1, of the value's ``count`` rows."""
    return running_counts(counts, by=by, value=value, count=count, rows=rows).withColumn("rank", F.col("_end") - (F.col(count) - 1) / 2).drop("_end")


def spearman(df: DataFrame, *, by: list[str], a: str, b: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """(by, rho, n): the correlation of the average ranks of two columns within each group, over rows that have both. Rows of equal pairs are counted first. Where no group has more than ``rows`` different pairs, two
    windows rank them; else values are ranked by ranges, and a value that many different pairs share is dealt over several tasks when its rank is looked up. Null where a column doesn't vary."""
    pairs = stored(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*by, F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count("*").alias("_c")))
    if not pairs.groupBy(*by).count().where(F.col("count") > rows).limit(1).count():
        for c in ("_a", "_b"):
            upto = F.sum("_c").over(Window.partitionBy(*by).orderBy(c))  # equal values are in one frame
            pairs = pairs.withColumn(f"{c}r", upto - (F.sum("_c").over(Window.partitionBy(*by, c)) - 1) / 2)
        return _correlation(pairs, by)
    for c in ("_a", "_b"):
        on = [*by, c]
        single = pairs.groupBy(*on).agg(F.sum("_c").alias("_c"), F.count("*").alias("_pairs"))
        ranks = stored(average_ranks(single, by=by, value=c, count="_c", rows=rows).withColumn("_salts", F.ceil(F.col("_pairs") / rows).cast("int")))
        hot = ranks.where("_salts > 1").select(*(F.col(k).alias(f"_h_{k}") for k in on), F.col("_salts").alias("_h_salts"))
        dealt, many = pairs.withColumn("_h_salts", F.lit(1)), hot.count()  # at most pairs / rows
        if many:
            dealt = pairs.join(F.broadcast(hot) if many <= SENT_GROUPS else hot, _equal(on, "_h_"), "left").drop(*(f"_h_{k}" for k in on))
        dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64("_a", "_b"), F.coalesce("_h_salts", F.lit(1))).cast("int")).drop("_h_salts")
        copied = ranks.select(*(F.col(k).alias(f"_g_{k}") for k in on), F.col("rank").alias(f"{c}r"), F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_g_salt"))
        pairs = dealt.join(copied, _equal(on) & (F.col("_salt") == F.col("_g_salt"))).drop(*(f"_g_{k}" for k in on), "_g_salt", "_salt")
    return _correlation(pairs, by)


def _correlation(pairs: DataFrame, by: list[str]) -> DataFrame:
    """(by, rho, n) of the ranks ``_ar`` and ``_br`` of pairs that come ``_c`` times."""
    sizes = stored(pairs.groupBy(*by).agg(F.sum("_c").alias("n"))).select(*(F.col(k).alias(f"_g_{k}") for k in by), "n")
    both = _beside(pairs, sizes, by, sizes.count())
    # Ranks add up to n (n + 1) / 2, so they are centred before they are multiplied.
    x, y, c = F.col("_ar") - (F.col("n") + 1) / 2, F.col("_br") - (F.col("n") + 1) / 2, F.col("_c")
    out = both.groupBy(*by).agg(F.sum(c * x * y).alias("xy"), F.sum(c * x * x).alias("xx"), F.sum(c * y * y).alias("yy"), F.max("n").alias("n"))
    return out.select(*by, F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt("xx") / F.sqrt("yy")).alias("rho"), "n")
