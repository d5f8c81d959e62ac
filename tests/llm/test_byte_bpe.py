"""Byte-level BPE against the library of the rank file, plain merging by rank, and round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_bpe
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TOKENS = byte_bpe.read_ranks(byte_bpe.ranks_path())
HALVES = byte_bpe.halves(TOKENS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(TOKENS, *HALVES, public_tokenizers.PATTERN)


def expected(text: str) -> bytes:
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


def test_query_equals_library(spark):
    rows = {r.doc_id: r for r in QUERIES["op11_byte_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = expected(d.text or "")
        assert (rows[d.doc_id].n_tokens, rows[d.doc_id].ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert rows[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text())
def test_any_text(text):
    e = test_any_text.__dict__.setdefault("e", byte_bpe.Encoder(TOKENS, *HALVES, public_tokenizers.PATTERN))
    assert e(text) == expected(text)


def test_narrow_alphabets(encoder):
    rng = random.Random(5)
    for _ in range(5_000):
        letters = rng.choice(["abc", "aab ", "theing ", "éèà", " \n\t\r\x0b\x1c\x85　", "0123", "日本語の", "'s tdmREVL"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        assert encoder(text) == expected(text), text


def test_long_pieces(encoder):
    rng = random.Random(6)
    for text in ("a" * 5_000, "ab" * 3_000, "".join(rng.choice("abcdefgh") for _ in range(5_000)), " " * 5_000 + "x", "=" * 5_000):
        assert encoder(text) == expected(text)


def merged(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Merging by rank, the plain way."""
    if piece in rank:
        return [rank[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank]
        if not found:
            return [rank[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(20))
def test_random_vocabularies(seed):
    """Vocabularies of any merges, with tokens that merging never builds: their parts lack."""
    rng = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)]
    pool = [b"a", b"b", b"c"]
    while len(tokens) < 330:
        t = rng.choice(pool) + rng.choice(pool)
        if t not in tokens:
            tokens.append(t)
            pool.append(t)
    for t in (b"abcabcabcacbbca", b"cabbaccabacabbb"):
        if t not in tokens:
            tokens.append(t)
    try:
        halves = byte_bpe.halves(tokens)
    except ValueError:  # merging builds one of these from a higher rank
        return
    e, rank = byte_bpe.Encoder(tokens, *halves, r"\S+"), {t: i for i, t in enumerate(tokens)}
    for _ in range(300):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))
        assert np.frombuffer(e(text), "<u4").tolist() == merged(text.encode(), rank), text
    assert e("abcabcabcacbbca") == np.array(merged(b"abcabcabcacbbca", rank), "<u4").tobytes()


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a", 7), (2, "", "b", None), (3, "x" * 4_000, None, 1), (3, "x" * 4_000, None, 1), (None, "<|endoftext|> \U0001f600", "c", 2)], "doc_id long, text string, ids string, decoded int").repartition(3)
    rows = byte_bpe.decode(byte_bpe.encode(df)).collect()
    assert len(rows) == 5
    for r in rows:
        assert (r.ids, r.decoded) == ((None, None) if r.text is None else (expected(r.text), r.text.encode()))
    assert byte_bpe.decode(byte_bpe.encode(df.limit(0))).count() == 0


def test_refuses_faulty_vocabularies():
    with pytest.raises(ValueError, match="single bytes"):
        byte_bpe.halves([b"a", b"b"])
    with pytest.raises(ValueError, match="higher rank"):
        byte_bpe.halves([*(bytes([b]) for b in range(256)), b"abc", b"ab"])
