"""Document fingerprints: one-permutation MinHash, optimal densification, packed low-order bits.

Each word 5-gram of a text is hashed once; the hash's top bits name its bin, and a bin keeps its least hash. An empty bin
copies that of another, found by its own sequence of probes, the same for every text. Of each bin the low
:data:`BITS` bits are kept and packed. The likeness of two fingerprints is their share of equal bins, corrected for bins that are
equal by chance: an estimate of the Jaccard similarity of the texts' sets.

Nulls and edge cases: a null text is empty; texts of fewer than five words have one gram of all of them; a text without words
has the fingerprint "", whose likeness is 1 to itself and 0 to others; ties of the key are ordered by text; a null key comes
first; a single row is its own next one; an empty table gives an empty result. The key is a whole number; another type raises. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, mix, shingle_hashes, small_batches, words_of

BINS, BITS = 512, 4
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_EDGES = np.arange(BINS, dtype=np.uint64) << _SHIFT
#: Rows of a block, on average, and blocks at most (their borders are in the plan).
BLOCK_ROWS, MOST_BLOCKS = 5_000, 20_000


def _probes(first: int, last: int, bins: np.ndarray | None = None) -> np.ndarray:
    x = (np.arange(BINS) if bins is None else bins).astype(np.uint64)[:, None] * np.uint64(1_000_003) + np.arange(first, last, dtype=np.uint64)[None, :]
    return (mix(mix(x + np.uint64(77))) % np.uint64(BINS)).astype(np.int64)


_ROUNDS = [_probes(0, 8), _probes(8, 128), _probes(128, 4096)]


def sketch(grams: np.ndarray) -> np.ndarray | None:
    """The densified bins' low bits of a set of gram hashes (repeats allowed); None for an empty set."""
    if not len(grams):
        return None
    s = np.sort(grams)
    at = np.minimum(np.searchsorted(s, _EDGES), len(s) - 1)
    value = s[at]
    full = (value >> _SHIFT) == np.arange(BINS, dtype=np.uint64)
    donor = np.arange(BINS)
    empty = np.flatnonzero(~full)
    for probes in _ROUNDS:
        if not len(empty):
            break
        hit = full[probes[empty]]
        found = hit.any(1)
        donor[empty[found]] = probes[empty[found], hit[found].argmax(1)]
        empty = empty[~found]
    start = 4096
    while len(empty):  # rare, and only where very few bins are full
        probes = _probes(start, start + 4096, empty)
        hit, start = full[probes], start + 4096
        found = hit.any(1)
        donor[empty[found]] = probes[found, hit[found].argmax(1)]
        empty = empty[~found]
    return (mix(value[donor]) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(bins: np.ndarray | None) -> str:
    return "" if bins is None else ((bins[0::2] << 4) | bins[1::2]).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Bias-corrected estimate of the Jaccard similarity."""
    if a is None or b is None:
        return float(a is b)
    chance = 1 / (1 << BITS)
    return max(0.0, float(((a == b).mean() - chance) / (1 - chance)))


def sketches(texts: list[str], hasher: WordHasher) -> list[np.ndarray | None]:
    grams, at = shingle_hashes([words_of(t) for t in texts], hasher)
    return [sketch(grams[at[i] : at[i + 1]]) for i in range(len(texts))]


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the packed fingerprint of each whole text; other columns pass through."""
    small_batches(docs.sparkSession)
    docs = docs.drop(out)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            prints = [packed(x) for x in sketches([t or "" for t in b.column(text).to_pylist()], hasher)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prints, pa.string())], [*names, out])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())]))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (block, look, key, text) such that, sorted within their partition, each row of ``look`` 0 is followed by the next one
    in the order of the key over the whole table, the last by the first. Texts are shuffled once: blocks are
    ranges of the key, and the first row of each block is also dealt to the block before it, with ``look`` 1."""
    if docs.schema[key].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"{key} must be a whole number")
    low = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    rows = docs.select(low.alias("k"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = rows.count()
    blocks = max(1, min(MOST_BLOCKS, math.ceil(n / BLOCK_ROWS)))
    cuts = rows.agg(F.percentile_approx("k", [i / blocks for i in range(1, blocks)] or [0.5], 100 * blocks)).first()[0] or [] if n else []
    cuts = sorted(set(cuts))
    step = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    count = lambda xs, k: F.size(F.filter(xs, lambda x: x <= k))
    longs = lambda xs: F.lit(np.array(xs, dtype=np.int64))
    if groups:
        coarse = count(longs([g[0] for g in groups]), F.col("k"))
        fine = F.get(F.array(*(longs(g) for g in groups)), F.col("coarse") - 1)
        rows = rows.withColumn("coarse", coarse).withColumn("block", F.when(F.col("coarse") > 0, (F.col("coarse") - 1) * step + count(fine, F.col("k"))).otherwise(0)).drop("coarse")
    else:
        rows = rows.withColumn("block", F.lit(0))
    firsts = rows.groupBy("block").agg(F.min("k").alias("k")).orderBy("block").collect()  # one row for each block
    before = [(r["k"], firsts[i - 1]["block"]) for i, r in enumerate(firsts)]
    before = docs.sparkSession.createDataFrame(before, "k long, before int")
    both = F.array(F.struct(F.col("block"), F.lit(0).alias("look")), F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("block"), F.lit(1).alias("look"))))
    rows = rows.join(F.broadcast(before), "k", "left").select(F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x"), "k", "key", "text")
    rows = rows.select("x.block", "x.look", "k", "key", "text").repartition("block")
    return rows.sortWithinPartitions("block", "look", "k", "text").select("block", "look", "key", "text")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, last = WordHasher(), None
    for b in batches:
        rows = [*zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)]
        prints = sketches([r[3] for r in rows], hasher)
        pairs = []
        for r, p in zip(rows, prints, strict=True):
            if last is not None and last[0][0] == r[0] and not last[0][1]:
                pairs.append((last[0], last[1], r, p))
            last = (r, p)
        edited = [a[3][: len(a[3]) - len(a[3]) // 2] + z[3][: len(a[3]) // 2] for a, _, z, _ in pairs]
        ep = sketches(edited, hasher)
        cols = [
            pa.array([a[2] for a, *_ in pairs], b.schema.field(2).type), pa.array([len(a[3]) for a, *_ in pairs], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            pa.array([packed(p) for _, p, _, _ in pairs], pa.string()), pa.array([packed(p) for p in ep], pa.string()),
            pa.array([likeness(p, e) for (_, p, _, _), e in zip(pairs, ep, strict=True)], pa.float64()), pa.array([likeness(p, q) for _, p, _, q in pairs], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(cols, ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, whose second half is the start of the next text, and their likeness."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, key, text).mapInArrow(_compare, schema).withColumnRenamed("key", key)
