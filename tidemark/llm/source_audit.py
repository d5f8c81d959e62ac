"""How far the sources of a language differ in their words: exact divergence of every pair of sources, and each source's telling terms.

A term's share in a group (language, source) is ``1 + floor(10^9 (count + 5) / (N + 5 V))``, for the V terms that at least ``least_docs`` documents of the language have; two groups
differ in it by the difference of their shares. That depends on two counts only, so sums over the vocabulary are taken over run-length columns: the vocabulary is dealt into blocks of terms of a
like total, a block's terms are put into an order in which equal counts lie together, and each group's counts become runs. For two
groups the borders of their runs are merged, and each stretch adds the difference once, times its length. Blocks are summed per pair.

Words are counted in each task by source and language before anything is shuffled, so neither a hot source nor a frequent word
meets in one task. A pair's work is the number of its runs, not of terms. All sums are integers.

Nulls and edge cases: null texts, languages and sources are ''; groups without terms take part with counts of 0; a language without kept terms gives pairs
of 0 and no terms; repeated rows count again; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches, written

SCALE, SMOOTH = 1_000_000_000, 5
#: Counts that a task holds before it hands them on, terms of one block, and groups of one tile.
HELD, BLOCK, TILE = 400_000, 1_024, 32
#: ASCII but letters become spaces, which split() drops; A-Z become a-z; bytes from \x80 on stay.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), summed as far as a task holds them."""
    total: dict[tuple[str, str], Counter] = defaultdict(Counter)
    holders: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def out() -> pa.RecordBatch:
        keys = [(k, t) for k, c in total.items() for t in c]
        cols = [pa.array([k[0] for k, _ in keys]), pa.array([k[1] for k, _ in keys]), pa.array([t.decode("utf-8", "surrogatepass") for _, t in keys]), pa.array([total[k][t] for k, t in keys], pa.int64()), pa.array([holders[k][t] for k, t in keys], pa.int64())]
        total.clear()
        holders.clear()
        return pa.RecordBatch.from_arrays([cols[0].cast(pa.string()), cols[1].cast(pa.string()), cols[2].cast(pa.string()), *cols[3:]], ["lang", "source", "term", "n", "docs"])

    for b in batches:
        for text, *key in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            words = terms_of(text)
            total[*key].update(words)
            holders[*key].update(set(words))
        if sum(map(len, total.values())) > HELD:
            yield out()
    yield out()


def counts_of(docs: DataFrame, *, text: str, lang: str, source: str) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, docs) of every term, and the groups that occur."""
    blank = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(blank(text, "text"), blank(lang, "lang"), blank(source, "source"))
    small_batches(docs.sparkSession)
    n = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return written(n.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))), cut(rows.select("lang", "source").distinct())


def share(count: Column, total: Column, kept: Column) -> Column:
    """The share of a term, as an integer, exact at any size."""
    return 1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(19,0)"), (total + SMOOTH * kept).cast("decimal(19,0)"))


def _runs(block: pa.Table) -> pa.Table:
    """The run-length columns of one block, one for each group of its language. Rows with a term hold its counts by group; the others name a group with the divisor of its shares."""
    lang, number, source = block.column("lang")[0].as_py(), block.column("block")[0].as_py(), block.column("source")
    groups = block.filter(pc.is_valid(source)).sort_by("source")
    names, divisor = groups.column("source").to_pylist(), groups.column("divisor").to_pylist()
    counts = block.filter(pc.is_null(source)).sort_by("term").column("counts").combine_chunks()
    ends = counts.offsets.to_numpy()
    at = {s: k for k, s in enumerate(names)}
    table = np.zeros((len(names), len(counts)), np.int64)
    held = counts.flatten()
    table[np.array([at[s] for s in held.field("source").to_pylist()], int), np.repeat(np.arange(len(counts)), np.diff(ends))] = held.field("n").to_numpy()
    table = table[:, np.lexsort(table[np.argsort((table > 0).sum(1), kind="stable")])]  # the last key, that of most terms, comes first
    last, value = [], []
    for k, row in enumerate(table):
        end = np.append(np.flatnonzero(row[1:] != row[:-1]) + 1, len(row))
        last.append(end.astype("<i4").tobytes())
        value.append(np.array([1 + SCALE * (c + SMOOTH) // divisor[k] for c in row[end - 1].tolist()], "<i8").tobytes())
    n = len(names)
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "block": pa.array([number] * n, pa.string()), "no": groups.column("no"), "ends": pa.array(last, pa.binary()), "shares": pa.array(value, pa.binary())})


def difference(ends_a: np.ndarray, a: np.ndarray, ends_b: np.ndarray, b: np.ndarray) -> int:
    """The sum of |a - b| over two run-length columns of the same length: a stretch between merged borders counts once, times its length."""
    ends = np.union1d(ends_a, ends_b)
    length = np.diff(ends, prepend=0)
    return int((np.abs(a[np.searchsorted(ends_a, ends)] - b[np.searchsorted(ends_b, ends)]) * length).sum())


def _pairs(tile: pa.Table) -> pa.Table:
    """(lang, a, b, value) for the pairs of two tiles of groups, over one block."""
    cols = [(no, side, np.frombuffer(e, "<i4"), np.frombuffer(p, "<i8")) for no, side, e, p in zip(*(tile.column(c).to_pylist() for c in ("no", "side", "ends", "shares")), strict=True)]
    one, two = [c for c in cols if c[1] <= 0], [c for c in cols if c[1] >= 0]
    out = [(x[0], y[0], difference(*x[2:], *y[2:])) for x in one for y in two if x[0] < y[0]]
    lang = tile.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), **{c: pa.array([r[k] for r in out], pa.int64()) for k, c in enumerate(("a", "b", "value"))}})


def _pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of the pairs a < b by number of their groups, summed over the blocks of the vocabulary."""
    terms = kept.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("counts"), F.floor(F.log2(F.sum("n"))).cast("int").alias("grade"))
    sizes = terms.groupBy("lang", "grade").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    name = lambda part: F.concat_ws(".", F.col("grade").cast("string"), part.cast("string"))
    terms = terms.join(sizes, ["lang", "grade"]).withColumn("block", name(F.pmod(F.xxhash64("term"), F.col("blocks"))))
    blocks = cut(terms.select("lang", "block", "term", "counts"))
    members = blocks.select("lang", "block").distinct().join(groups, "lang").select("lang", "block", "source", "no", "divisor")
    runs = written(blocks.unionByName(members, allowMissingColumns=True).groupBy("lang", "block").applyInArrow(_runs, "lang string, block string, no long, ends binary, shares binary"))
    tile, tiles = F.floor(F.col("no") / TILE), F.floor((F.col("of") - 1) / TILE)
    of = groups.groupBy("lang").agg(F.count("*").alias("of"))
    runs = runs.join(of, "lang").withColumns({"tile": tile, "other": F.explode(F.sequence(F.lit(0).cast("long"), tiles))})
    runs = runs.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other"), "side": F.signum(F.col("tile") - F.col("other")).cast("int")})
    parts = runs.select("lang", "block", "low", "high", "no", "side", "ends", "shares").groupBy("lang", "block", "low", "high").applyInArrow(_pairs, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has each other source with the sum of differences, part ``term`` the ``top`` terms whose
    share is above the language's, by difference; ties go by item."""
    counts, groups = counts_of(docs, text=text, lang=lang, source=source)
    whole = cut(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= least_docs).drop("docs"))
    langs = whole.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    kept = written(counts.drop("docs").join(whole, ["lang", "term"]))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
    groups = cut(groups.withColumns({"no": F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1, "divisor": F.col("total") + SMOOTH * F.col("kept")}))

    value = _pair_values(kept.select("lang", "source", "term", "n"), groups.select("lang", "source", "no", "divisor"))
    both = value.select("lang", "a", "b", "value").unionByName(value.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    one = groups.select("lang", "source", F.col("no").alias("a"))
    pairs = one.join(groups.select("lang", F.col("source").alias("item"), F.col("no").alias("b")), "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")).withColumn("rank", F.row_number().over(by))

    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("all"), F.col("lang_total"), F.col("kept"))
    terms = kept.join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).cast("long").alias("value"))
    terms = terms.where("value > 0").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
