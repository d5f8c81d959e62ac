"""The divergence audit against SQL and a plain version, on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.compare import connection, differences
from tidemark.llm import source_audit
from tidemark.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least: int, top: int) -> set[tuple]:
    """The definition, term by term."""
    count, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]
        groups.add((lang, source))
        count[lang, source].update(words)
        holders[lang].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, k in holders[lang].items() if k >= least), key=str.encode)
        sources = sorted(s for a, s in groups if a == lang)
        share = lambda c: [1 + 10**9 * (c[t] + 5) // (sum(c[u] for u in kept) + 5 * len(kept)) for t in kept]
        p = {s: share(count[lang, s]) for s in sources}
        q = share(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted(((sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o) for o in sources if o != s), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "pair", o, v, k + 1) for k, (v, o) in enumerate(pairs)}
            terms = sorted(((a - b, t) for a, b, t in zip(p[s], q, kept, strict=True) if a > b and count[lang, s][t]), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "term", t, v, k + 1) for k, (v, t) in enumerate(terms[:top])}
    return out


def test_query_equals_sql(spark):
    assert differences(QUERIES["op13_source_divergence"](spark, "/root/testdata/sf0.01"), connection("/root/testdata/sf0.01"), ORACLES["op13_source_divergence"]) == ""


@pytest.mark.parametrize("seed", range(3))
def test_random_corpora(spark, seed, monkeypatch):
    """Many sources and tiny blocks and tiles, so that pairs meet over several of each; a third of all rows in one source."""
    monkeypatch.setattr(source_audit, "BLOCK", 8)
    monkeypatch.setattr(source_audit, "TILE", 3)
    monkeypatch.setattr(source_audit, "HELD", 200)
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "abÉz" for b in "eiÖu" for c in "lnR日"]
    rows = [(" ".join(rng.choice(vocabulary[: rng.choice([3, 20, 64])]) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None]), rng.choice(["hot"] * 5 + [f"s{k}" for k in range(10)])) for _ in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert {tuple(r) for r in source_audit.audit(df, least_docs=4, top=5).collect()} == plain(rows, 4, 5)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "", "a"), ("Word wORD\x00été\x7f-1_x", "en", "a"), ("word", "en", "b"), ("word", "en", "b"), ("été " * 5_000, "en", None), ("...", "fr", "x"), ("only here", "fr", "y")]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, n int, term string").repartition(3)
    got = source_audit.audit(df, least_docs=1).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == plain(rows, 1, 50)
    assert {tuple(r) for r in source_audit.audit(df, least_docs=9).collect()} == plain(rows, 9, 50)  # no term is kept
    assert source_audit.audit(df.limit(0)).count() == 0


def test_difference_of_runs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 3, 40), rng.integers(0, 3, 40)
        runs = [(np.append(np.flatnonzero(x[1:] != x[:-1]) + 1, 40), x) for x in (a, b)]
        (ea, xa), (eb, xb) = ((e, x[e - 1]) for e, x in runs)
        assert source_audit.difference(ea, xa, eb, xb) == np.abs(a - b).sum()


def test_shares_of_huge_counts(spark):
    from pyspark.sql import functions as F

    n, total, kept = 9_000_000_000_000, 80_000_000_000_000, 3_000_000
    row = spark.range(1).select(source_audit.share(F.lit(n), F.lit(total), F.lit(kept).cast("long")).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * kept)
