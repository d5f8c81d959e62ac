"""Byte-level BPE by longest matches and backtracking, in time linear in the text; decoding.

A text is cut by the vocabulary's pattern, and each piece is encoded by itself. Its bytes are mapped to Latin-1, so that one automaton over
characters finds the longest token from every place in one scan. From the left, the longest token is taken that may stand behind the one before it; where none may,
the last token is taken back and a shorter one tried, and the place is marked as a dead end, so that no place is left twice. Two tokens may stand side by side
if merging would leave the border between them: undoing the merges of both, latest first, never shows a pair at the border that would have been
merged before. That answer is kept for pairs seen before.

Such a sequence is unique and is what merging by rank gives, provided that merges build larger ranks from smaller ones, which is checked. A token that merging never builds
is only used for a piece that equals it.

Nulls and edge cases: a null text has null ids (and decodes to null), an empty one has none; repeated rows are equal; an empty table
gives an empty result; extra columns pass through, one named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Pieces and pairs of tokens that a worker keeps, and the longest piece kept, in characters.
KEPT_PIECES, KEPT_PAIRS, KEPT_CHARS = 400_000, 500_000, 64


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank: a vocabulary, of a fixed size."""
    import base64

    with open(path, "rb") as f:
        rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tokens = [b""] * (max(rank.values()) + 1)
    for t, k in rank.items():
        tokens[k] = t
    return tokens


def halves(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two tokens that each one is merged from; a single byte's are itself, and -1 those of a token that merging never builds."""
    rank = {t: i for i, t in enumerate(tokens) if t}
    if any(bytes([b]) not in rank for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    left, right = np.full(len(tokens), -1, np.int64), np.full(len(tokens), -1, np.int64)
    for t, i in rank.items():
        parts = [rank[t[k : k + 1]] for k in range(len(t))]
        while len(parts) > 2:
            best = min(((rank.get(tokens[a] + tokens[b], len(tokens)), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=None)
            if best[0] == len(tokens):
                break
            parts[best[1] : best[1] + 2] = [best[0]]
        if len(parts) == 1:
            left[i] = right[i] = i
        elif len(parts) == 2:
            left[i], right[i] = parts
            if max(parts) >= i:
                raise ValueError("a token is merged from one of a higher rank")
    return left, right


class Encoder:
    """Encodes texts to packed little-endian 32-bit ids."""

    def __init__(self, tokens: list[bytes], left: np.ndarray, right: np.ndarray, pattern: str):
        import ahocorasick
        import regex

        self.tokens, self._left, self._right = tokens, left.tolist(), right.tolist()
        self._rank = {t: i for i, t in enumerate(tokens) if t}
        self._pair = {(a, b): i for i, (a, b) in enumerate(zip(self._left, self._right, strict=True)) if a >= 0 and len(tokens[i]) > 1}
        self._find, self._length = ahocorasick.Automaton(), [len(t) for t in tokens]
        for i, t in enumerate(tokens):
            if self._left[i] >= 0:
                self._find.add_word(t.decode("latin-1"), i)
        self._find.make_automaton()
        # The longest token that a token starts with and isn't.
        self._shorter = [next((self._rank[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self._rank and self._left[self._rank[t[:k]]] >= 0), -1) for t in tokens]
        self._split = regex.compile(pattern).findall
        self._fits: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, bytes] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves a border between tokens a and b."""
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) >= KEPT_PAIRS:
                self._fits.clear()
            known = self._fits[a, b] = self._stays(a, b)
        return known

    def _stays(self, a: int, b: int) -> bool:
        """The later of the two is undone, step by step; a merge over the border is one that would have come before what was undone last. On a tie the left pair comes first."""
        pair, left, right, before = self._pair, self._left, self._right, len(self.tokens)
        while True:
            if pair.get((a, b), before) < before:
                return False
            if a > b:
                before, a = a, right[a]
                if a == before:  # a single byte: only the other side can be undone
                    before, b = b + 1, left[b]
                    if b + 1 == before:
                        return True
            else:
                before, b = b + 1, left[b]
                if b + 1 == before:
                    before, a = a, right[a]
                    if a == before:
                        return True

    def piece(self, piece: str) -> list[int]:
        data = piece.encode()
        whole = self._rank.get(data)
        if whole is not None:
            return [whole]
        length, shorter, fits, n = self._length, self._shorter, self.fits, len(data)
        longest = [0] * n
        for end, i in self._find.iter(data.decode("latin-1")):
            longest[end + 1 - length[i]] = i  # ends rise, so the longest stays
        alive, out, at, token = bytearray(b"\1" * (n + 1)), [], 0, longest[0]
        while at < n:
            end = at + length[token]
            if alive[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                alive[at] = 0
                token = out.pop()
                at -= length[token]
        return out

    def _kept(self, piece: str) -> bytes:
        ids = np.array(self.piece(piece), "<u4").tobytes()
        if len(piece) <= KEPT_CHARS:
            if len(self._pieces) >= KEPT_PIECES:
                self._pieces.clear()
            self._pieces[piece] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        known = self._pieces.get
        return b"".join([known(p) or self._kept(p) for p in self._split(text)])


def encode(docs: DataFrame, *, path: str | None = None, pattern: str | None = None, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``, the ids of each whole text as packed little-endian unsigned 32-bit integers. The rank file is read by the driver, which sends the tokens and their halves to the tasks."""
    import public_tokenizers

    spark = docs.sparkSession
    small_batches(spark)
    tokens = read_ranks(path or ranks_path())
    sent, pattern, docs = spark.sparkContext.broadcast((tokens, *halves(tokens))), pattern or public_tokenizers.PATTERN, docs.drop(out)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*sent.value, pattern)
        for b in batches:
            ids = [None if t is None else encoder(t) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], [*names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.BinaryType())]))


def decode(docs: DataFrame, *, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that packed ids stand for. Ids that the vocabulary lacks raise an error."""
    spark = docs.sparkSession
    small_batches(spark)
    sent, docs = spark.sparkContext.broadcast(read_ranks(path or ranks_path())), docs.drop(out)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = sent.value.__getitem__
        for b in batches:
            back = [None if x is None else b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.binary())], [*names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.BinaryType())]))
