"""Quality rules with thresholds that follow the data.

Each text gets counts of words, symbols, repeated lines and repeated passages. For every (language, source) a
sketch of each ratio is built: how many texts fall into each bin of a fixed grid whose bins grow by a tenth of a percent. Such sketches merge by adding counts, and are a function of the rows alone, so the
same table gives the same verdicts in every run. Sketches of small groups are replaced by the merged sketch of their language, and of
small languages by that of all rows. A text fails where a ratio lies far above the lower part of its group. Both quantiles are below the
median, so that a source of which more than half is junk can't vouch for itself; a group without spread takes that of its language, or of all
rows. DataFrame functions only.

Nulls and edge cases: a null or empty text has no words and fails the base rule; null languages and
sources are groups of their own; an empty table gives an empty result; repeated rows get equal verdicts. Extra columns
pass through: ``keep_good`` returns its rows whole under any names, ``apply_rules`` replaces columns that are named like one of its outputs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import copied, cut, hot_keys, private, spread

MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Ratio, with the slack that is added to its fence: below it a value is no reason to reject a text.
RATIOS = {"symbol_ratio": 0.03, "dup_line_ratio": 0.05, "repeat_ratio": 0.25, "word_length": 2.0}
#: The fence is the upper quantile plus REACH times the range between the two.
LOWER, UPPER, REACH = 0.1, 0.4, 8.0
#: Groups of fewer rows use the merged sketch of the level above.
MIN_GROUP = 200
#: Growth of the grid's bins; a quantile is found to half of that. Ratios lie between 10^-10 and 10^10 or are 0, so a sketch has 46,000 bins at most.
GROWTH = 1.001
#: Groups whose fences may be broadcast, some hundred bytes each.
BROADCAST_GROUPS = 10_000
_SPACE = r"[\x20\x09-\x0D]+"


def _counted(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and :data:`COUNTS`. Equal 8-word windows are found by their 64-bit hashes, put together by doubling."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.regexp_replace(t, _SPACE, "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # Other columns wait in one of their own, so that no name can clash.
    df = docs.select(F.struct(F.lit(0).alias("_"), *keep).alias("kept_"), F.array_remove(F.split(t, _SPACE), "").alias("_w"), bare.alias("_bare"), lines.alias("_lines"))
    df = df.select(
        "kept_", F.size("_w").cast("long").alias("n_words"), F.length("_bare").cast("long").alias("word_chars"),
        (F.length("_bare") - F.length(F.regexp_replace("_bare", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    done = ["kept_", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    joined = lambda k: F.transform("_h", lambda x, i: F.xxhash64(x, F.get("_h", i + k)))
    for k in (1, 2, 4):
        df = df.select(*done, joined(k).alias("_h"))
    df = df.select(*done, F.slice("_h", F.lit(1), F.greatest(F.col("n_words") - WINDOW + 1, F.lit(0)).cast("int")).alias("_h"))
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.select(*done, F.when(repeats, F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_s"))
    twice = F.filter("_s", lambda x, k: (x["h"] == F.get("_s", k - 1)["h"]) | (x["h"] == F.get("_s", k + 1)["h"]))
    df = df.select(*done, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_p"))
    covered = F.aggregate(F.transform("_p", lambda x, k: F.least(F.lit(WINDOW), F.get("_p", k + 1) - x)), F.lit(0), lambda a, x: a + x)
    df = df.select(*done, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    # A generator of one row: a later filter on the counts then stays above them, and doesn't count anew for each mention.
    return df.select(*(F.col("kept_")[c].alias(c) for c in keep), F.inline(F.array(F.struct(*COUNTS))))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add :data:`COUNTS`; columns of these names are replaced."""
    return _counted(docs, text, [c for c in docs.columns if c.lower() not in COUNTS])


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)), "dup_line_ratio": F.col("n_dup_lines") / words,
        "repeat_ratio": F.col("n_repeat_words") / words, "word_length": F.col("word_chars") / words,
    }


def _bin(x: Column) -> Column:
    """The bin of a ratio; null stands for zero."""
    return F.when(x > 0, F.floor(F.log(F.when(x > 0, x)) / F.lit(math.log(GROWTH))).cast("int"))


def _middle(bin_: Column) -> Column:
    return F.when(bin_.isNull(), 0.0).otherwise(F.exp((bin_ + 0.5) * F.lit(math.log(GROWTH))))


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, <ratio>_lo, <ratio>_up) of the sketch summed over all but ``by``: counts by ratio and bin."""
    bins = sketch.groupBy(*by, "ratio", "bin").agg(F.sum("c").alias("c"))
    w = Window.partitionBy(*by, "ratio")
    upto = bins.withColumns({"upto": F.sum("c").over(w.orderBy(F.asc_nulls_first("bin")).rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("c").over(w)})
    at = lambda share: F.min(F.when(F.col("upto") >= F.col("n") * share, _middle(F.col("bin"))))
    one = upto.groupBy(*by, "ratio").agg(F.max("n").alias("n"), at(LOWER).alias("lo"), at(UPPER).alias("up"))
    pick = lambda i, c: F.max(F.when(F.col("ratio") == i, F.col(c)))
    return one.groupBy(*by).agg(F.max("n").alias("n"), *(pick(i, c).alias(f"{r}_{c}") for i, r in enumerate(RATIOS) for c in ("lo", "up")))


def thresholds(counted: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """One row for each (language, source): ``group``, the two as text, and the fence of every ratio."""
    rows = counted.where(F.col("n_words") > 0).select(F.to_json(F.struct(F.col(keys[0]).alias("a"))).alias("k"), _group(keys).alias("group"), F.posexplode(F.array(*map(_bin, ratios().values()))).alias("ratio", "bin"))
    sketch = cut(rows.groupBy("k", "group", "ratio", "bin").agg(F.count("*").alias("c")))
    whole = F.struct("n", *(f"{r}_{c}" for r in RATIOS for c in ("lo", "up")))
    own = _quantiles(sketch, ["k", "group"]).select("group", "k", whole.alias("own"))
    up = _quantiles(sketch, ["k"]).select(F.col("k").alias("up"), whole.alias("lang"))
    every = _quantiles(sketch.withColumn("one", F.lit(1)), ["one"]).select(whole.alias("all"))
    df = own.join(up, F.col("k") == F.col("up")).withColumn("all", every.scalar())
    df = df.select("group", F.when(F.col("own.n") >= MIN_GROUP, F.col("own")).when(F.col("lang.n") >= MIN_GROUP, F.col("lang")).otherwise(F.col("all")).alias("s"), "lang", "all")
    width = lambda level, r: F.col(f"{level}.{r}_up") - F.col(f"{level}.{r}_lo")
    fences = []
    for r, slack in RATIOS.items():
        spread_ = F.coalesce(*(F.when(width(level, r) > 0, width(level, r)) for level in ("s", "lang", "all")), F.lit(0.0))
        fences.append(F.col(f"s.{r}_up") + REACH * spread_ + slack)
    return cut(df.select("group", *(f.alias(r) for r, f in zip(RATIOS, fences, strict=True))))


def _group(keys: tuple[str, str]) -> Column:
    """Both keys as one text; a null is not there."""
    return F.to_json(F.struct(F.col(keys[0]).alias("a"), F.col(keys[1]).alias("b")))


def _judged(counted: DataFrame, limits: DataFrame, keys: tuple[str, str]) -> tuple[DataFrame, str]:
    """``counted`` with base_failed, kept and the fences under private names, and the prefix of those. Fences are broadcast if there are few groups; else large groups are dealt out."""
    p = private(counted)
    named = limits.toDF(*(p + c for c in limits.columns))
    df = counted.withColumn(f"{p}group", _group(keys))
    if limits.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        df = df.join(F.broadcast(named), f"{p}group", "left")
    else:
        hot = hot_keys(df, f"{p}group", 100_000)
        df = spread(df, f"{p}group", hot, *(c for c in COUNTS)).join(copied(named, f"{p}group", hot), [f"{p}group", "_salt"], "left").drop("_salt")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    odd = F.lit(False)
    for r, x in ratios().items():
        odd = odd | F.coalesce(x > F.col(f"{p}{r}"), F.lit(False))
    return df.withColumns({f"{p}base": base, f"{p}good": ~base & ~odd}), p


def apply_rules(docs: DataFrame, text: str = "text", keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and all other columns but the text, for each row of ``docs``."""
    counted = cut(with_counts(docs, text).drop(text))
    df, p = _judged(counted, thresholds(counted, keys), keys)
    names = [c for c in counted.columns if c.lower() not in ("base_failed", "kept")]
    return df.select(*names, F.col(f"{p}base").alias("base_failed"), F.col(f"{p}good").alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The rows of ``docs`` that pass, whole. Texts are counted twice rather than shuffled."""
    limits = thresholds(cut(_counted(docs, text, [*keys])), keys)
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text_"), *(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)))
    df, p = _judged(_counted(packed, "text_", ["row", "k0", "k1"]), limits, ("k0", "k1"))
    return df.where(f"{p}good").select("row.*")
