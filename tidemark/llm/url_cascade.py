"""URL filters by a cascade of Bloom filters: exact verdicts without a join.

A rule is a host and a path prefix; it fits its host and all subdomains where the path starts with the rule's. The keys
that any rule could fit a url by are its host suffixes with the path prefixes of the lengths in use. Level 1
encodes the listed keys; level 2 those of the corpus's other keys that level 1 lets through by mistake; level 3 the
listed keys that level 2 catches; and so on until no mistake is left. Over the complete key universe of the
corpus the answer is exact. A second cascade over listed keys tells blocked from allowed ones. DataFrame functions only.

Nulls and edge cases: a url that is null or has no ``://`` has an empty host and path and fits no rule; no rule gives "allow";
empty tables and empty rule lists work; repeated rows are judged alike; the longest fitting rule wins, and of
an allow and a block rule that are equal, block. Input columns named like an output are replaced; others pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, private

#: Bits of one level's filter at most (4 MB): the filter travels inside the plan, so its size must be bounded. Longer lists are split by the hash of the key into several cascades.
MAX_BITS = 1 << 25
#: Splits whose filters are in one plan; the rows of more are judged one such set after the other.
MOST_SPLITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))
    return df.drop("host", "path").withColumns({"host": F.translate(F.regexp_extract(u, _URL, 1), _UPPER, _LOWER), "path": F.regexp_extract(u, _URL, 2)})


def candidate_keys(lengths: list[int], most: int) -> Column:
    """All keys by which a rule could fit (host, path), longest first. ``most``: labels of the longest listed host."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda i: F.array_join(F.slice(labels, -i, i), "."))
    fitting = F.filter(F.array(*map(F.lit, sorted(lengths, reverse=True))), lambda n: n <= F.length("path"))
    paths = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(paths, lambda p: F.struct((-F.length(s) - F.length(p)).alias("n"), F.concat(s, p).alias("key")))))
    return F.transform(F.sort_array(keys), lambda x: x["key"])


@dataclass
class Level:
    seed: int
    bits: int
    hashes: int
    words: np.ndarray

    def at(self, key: Column, j: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(j)), F.lit(self.bits))

    def has(self, key: Column) -> Column:
        def held(words: Column) -> Column:
            found = F.lit(True)
            for j in range(self.hashes):
                at = self.at(key, j)
                found = found & (F.get(words, (at / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))) != 0)
            return found

        return F.get(F.transform(F.array(F.lit(self.words)), held), F.lit(0))  # the filter is in the plan once


def _bits(n: int, rate: float) -> int:
    return max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))


def _rate(n_in: int, n_out: int) -> float:
    """How many of the other keys a first level should let through."""
    return min(0.5, max(1e-9, n_in / (math.sqrt(2) * max(1, n_out))))


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    bits = _bits(n, rate)
    level = Level(seed, bits, max(1, round(bits / max(1, n) * math.log(2))) if bits > 64 else 3, np.zeros(math.ceil(bits / 64), dtype=np.int64))
    at = keys.select(F.explode(F.array(*(level.at(F.col("key"), j) for j in range(level.hashes)))).alias("at"))
    words = at.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("bits"))
    for r in words.toLocalIterator():  # at most bits / 64 rows
        level.words[r["word"]] = r["bits"]
    return level


class Cascade:
    """Exact membership of ``listed`` within ``listed`` and ``others`` together (columns ``key``, each distinct, disjoint)."""

    def __init__(self, listed: DataFrame, others: DataFrame):
        self.levels: list[Level] = []
        inside, outside, n_in, n_out = listed, others, listed.count(), others.count()
        while n_in:
            rate = _rate(n_in, n_out) if not self.levels else 0.5
            level = _level(inside, n_in, rate, len(self.levels))
            self.levels.append(level)
            inside, outside, n_out = cut(outside.where(level.has(F.col("key")))), inside, n_in
            n_in = inside.count()

    def has(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed([*enumerate(self.levels)]):
            answer = F.when(level.has(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


class Cascades:
    """Exact membership in a list of any size: keys are dealt by their hash over as many cascades as keep every filter within :data:`MAX_BITS`."""

    def __init__(self, listed: DataFrame, others: DataFrame):
        n_in, n_out = listed.count(), others.count()
        # A split may get a few more keys than its share; a tenth is left for that.
        self.splits = max(1, math.ceil(1.1 * _bits(n_in, _rate(n_in, n_out)) / MAX_BITS)) if n_in else 1
        part = lambda df, i: df if self.splits == 1 else df.where(self._split(F.col("key")) == i)
        self.cascades = [Cascade(part(listed, i), part(others, i)) for i in range(self.splits)]

    def _split(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("split")), F.lit(self.splits))

    def sets(self) -> list[range]:
        """The splits that one plan may hold."""
        return [range(i, min(i + MOST_SPLITS, self.splits)) for i in range(0, self.splits, MOST_SPLITS)]

    def has(self, key: Column, splits: range) -> Column:
        """Whether ``key`` is listed, as far as it falls into ``splits``."""
        if self.splits == 1:
            return self.cascades[0].has(key)
        answer = F.lit(False)
        for i in splits:
            answer = F.when(self._split(key) == i, self.cascades[i].has(key)).otherwise(answer)
        return answer


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, rule (the longest listed key, or null) and verdict. ``rules``: columns host, path, verdict."""
    df = with_host_path(pages.drop("rule", "verdict"), url)
    listed = rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("n"), F.size(F.split("host", r"\.")).alias("labels"), (F.col("verdict") == "block").alias("block")).where("key is not null")
    # As many lengths as the longest listed path has characters, at most.
    lengths, most = [r["n"] for r in listed.select("n").distinct().collect()], listed.agg(F.max("labels")).first()[0]
    listed = cut(listed.groupBy("key").agg(F.max("block").alias("block")))
    if not lengths:
        return df.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    prefix = df.select("host", F.substring("path", 1, max(lengths)).alias("path")).distinct()
    universe = prefix.select(F.explode(candidate_keys(lengths, most)).alias("key")).distinct()
    member = Cascades(listed.select("key"), cut(universe.join(listed.select("key"), "key", "left_anti")))
    blocked = Cascades(listed.where("block").select("key"), listed.where("not block").select("key"))
    keys, hits, bad = candidate_keys(lengths, most), private(df) + "hits", private(df) + "bad"
    sets, within = member.sets(), lambda splits: lambda k: member.has(k, splits)
    df = df.withColumn(hits, F.filter(keys, within(sets[0])))
    for splits in sets[1:]:
        df = cut(df).withColumn(hits, F.concat(hits, F.filter(keys, within(splits))))
    longest = F.get(F.transform(F.sort_array(F.transform(hits, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("key")))), lambda x: x["key"]), F.lit(0))
    df = df.withColumn("rule", longest if len(sets) > 1 else F.get(hits, F.lit(0))).drop(hits)
    sets = blocked.sets()
    df = df.withColumn(bad, blocked.has(F.col("rule"), sets[0]))
    for splits in sets[1:]:
        df = cut(df).withColumn(bad, F.col(bad) | blocked.has(F.col("rule"), splits))
    return df.withColumn("verdict", F.when(F.col("rule").isNotNull() & F.col(bad), F.lit("block")).otherwise(F.lit("allow"))).drop(bad)


RULE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])
