"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees, boosted feature by feature in turn, add up to one lookup table for each feature; after them, trees
over pairs of features add up to small two-way tables. A document is scored by binning its
features and adding the table entries, vectorised over an Arrow batch.

Nulls and edge cases: a null or empty text has all-zero features and still gets a score; label rows with a null id or
null quality are left out of the fit; several labels of one id count once (the largest); with fewer than two classes
the score is the class share. Extra columns of the input pass through (one
named like the output is replaced), and repeated rows are scored alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

#: Labelled rows that the fit sees at most: a sample by hash of the id.
FIT_ROWS = 20_000
FEATURES = [
    "words", "chars_per_word", "distinct_share", "repeat_next", "upper", "symbols", "bars", "bangs", "digits", "stops",
    "commas", "white", "lines", "words_per_line", "dup_lines", "wide", "longest_word", "short_words", "top_word", "bigram_distinct",
]
_UPPER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_SYMBOL, _WHITE = b"#*$%&<>^~{}[]_=\\@", b" \t\n\r\x0b\x0c"
_WIDE = bytes(range(128, 256))


def features(texts: list[str | None]) -> np.ndarray:
    """Language-independent surface features of each whole text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        if not text:
            continue
        b = text.encode("utf-8", "surrogatepass")
        n, words = len(b), b.split()
        if not words:
            continue
        m = len(words)
        lines = [x for x in b.split(b"\n") if x.strip()]
        kinds = Counter(words)
        gone = lambda chars: n - len(b.translate(None, chars))
        lengths = list(map(len, words))
        nxt = sum(map(bytes.__eq__, words, words[1:]))
        pairs = len(set(zip(words, words[1:], strict=False)))
        common = max(kinds.values())
        out[i] = (
            m, n / m, len(kinds) / m, nxt / m, gone(_UPPER) / n, gone(_SYMBOL) / n, b.count(b"|") / m, b.count(b"!") / m, gone(_DIGIT) / n, b.count(b".") / m,
            b.count(b",") / m, gone(_WHITE) / n, len(lines), m / len(lines), 1 - len(set(lines)) / len(lines), gone(_WIDE) / n, max(lengths), sum(x < 3 for x in lengths) / m, common / m, pairs / max(1, m - 1),
        )
    return out


@dataclass
class AdditiveModel:
    """Lookup tables over bins; ``cuts[j]`` are the inner bin edges of feature ``j``."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]
        f = np.full(len(x), self.base)
        for t, b in zip(self.tables, bins, strict=True):
            f += t[b]
        for j, k, t in self.pairs:
            f += t[self.coarse[j][bins[j]], self.coarse[k][bins[k]]]
        return f

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Step of a regression tree with few leaves over ordered bins, from gradient and curvature sums."""
    spans, gain = [(0, len(g))], lambda a, b: a * a / (b + ridge)
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(spans) < leaves:
        best = None
        for s, (a, b) in enumerate(spans):
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            left = gain(cg[k] - cg[a], ch[k] - ch[a])
            v = left + gain(cg[b] - cg[k], ch[b] - ch[k]) - gain(cg[b] - cg[a], ch[b] - ch[a])
            at = int(np.argmax(v))
            if best is None or v[at] > best[0]:
                best = (v[at], s, int(k[at]))
        if best is None or best[0] <= 1e-9:
            break
        a, b = spans[best[1]]
        spans[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    step = np.zeros(len(g))
    for a, b in spans:
        step[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Best cut of either axis at once: gain and step of the four quadrants of a grid."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    q = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
    gain = sum(a * a / (b + ridge) for a, b in zip(q(cg), q(ch), strict=True))
    at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.zeros_like(g)
    for (r, c), a, b in zip(((slice(None, at[0] + 1), slice(None, at[1] + 1)), (slice(None, at[0] + 1), slice(at[1] + 1, None)), (slice(at[0] + 1, None), slice(None, at[1] + 1)), (slice(at[0] + 1, None), slice(at[1] + 1, None))), q(cg), q(ch), strict=True):
        step[r, c] = a[at] / (b[at] + ridge)
    return float(gain[at]), step


def fit(x: np.ndarray, y: np.ndarray, *, bins: int = 32, rounds: int = 120, rate: float = 0.15, leaves: int = 3, n_pairs: int = 6, pair_rounds: int = 40, ridge: float = 1.0) -> AdditiveModel:
    """Cyclic boosting of the logistic loss; deterministic."""
    p = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(p / (1 - p)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    model = AdditiveModel(base, cuts, tables)
    if len(np.unique(y)) < 2:
        return model
    at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    f = np.full(len(y), base)
    for _ in range(rounds):
        for j, b in enumerate(at):
            if len(tables[j]) < 2:
                continue
            prob = 1 / (1 + np.exp(-f))
            step = rate * _tree(np.bincount(b, y - prob, len(tables[j])), np.bincount(b, prob * (1 - prob), len(tables[j])), leaves, ridge)
            tables[j] += step
            f += step[b]
    model.coarse = [np.arange(len(t)) * min(8, len(t)) // len(t) for t in tables]
    small, side = [c[b] for c, b in zip(model.coarse, at, strict=True)], [int(c[-1]) + 1 for c in model.coarse]
    sums = lambda j, k, v: np.bincount(small[j] * side[k] + small[k], v, side[j] * side[k]).reshape(side[j], side[k])
    prob = 1 / (1 + np.exp(-f))
    rank = [(_pair_tree(sums(j, k, y - prob), sums(j, k, prob * (1 - prob)), ridge)[0], j, k) for j in range(len(at)) for k in range(j) if min(side[j], side[k]) > 1]
    chosen = [(j, k, np.zeros((side[j], side[k]))) for _, j, k in sorted(rank, reverse=True)[:n_pairs]]
    for _ in range(pair_rounds):
        for j, k, t in chosen:
            prob = 1 / (1 + np.exp(-f))
            step = rate * _pair_tree(sums(j, k, y - prob), sums(j, k, prob * (1 - prob)), ridge)[1]
            t += step
            f += step[small[j], small[k]]
    model.pairs = chosen
    return model


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = features(b.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column("y"), *(pa.array(x[:, j]) for j in range(x.shape[1]))], ["y", *FEATURES])


def fit_labelled(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit on documents with a row in ``labels`` (doc_id, quality). Beyond ``fit_rows`` labels a share by hash of the
    id is taken, and of their documents' different features at most ``fit_rows`` reach the driver, those of the smallest hashes."""
    spark = docs.sparkSession
    small_batches(spark)
    labels = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    share = min(1.0, fit_rows / max(1, labels.count()))
    labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003))
    rows = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("y", "text")  # at most about fit_rows ids
    schema = T.StructType([T.StructField("y", T.DoubleType())] + [T.StructField(c, T.DoubleType()) for c in FEATURES])
    rows = rows.mapInArrow(_featurize, schema).distinct()  # an id or a text that is repeated counts once
    data = rows.orderBy(F.xxhash64(*rows.columns), *rows.columns).limit(fit_rows).toPandas().sort_values(["y", *FEATURES]).to_numpy(dtype=float)
    return fit(data[:, 1:], (data[:, 0] >= 0.5).astype(float))


def score(docs: DataFrame, model: AdditiveModel, *, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of good quality of each whole text; every other column passes through."""
    small_batches(docs.sparkSession)
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(features(b.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*b.schema.names, out])

    return docs.mapInArrow(run, schema)
