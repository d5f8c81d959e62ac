"""Sampled SentencePiece segmentations by forward filtering and backward sampling; lossless decoding.

The lattice of a text has an edge for every vocabulary piece between two places of it, and for a character that no piece covers its UTF-8
bytes. An edge weighs as a unigram model's would: its log-probability falls with the logarithm of the piece's
rank. Forward filtering sums, for each place, the weight of all ways to it; backward sampling draws the last piece, then the
one before it, in proportion. No piece crosses from a word into the space after it, nor a line end, so the lattice falls into units, and all
units of an Arrow batch are filtered and drawn together in numpy, equal ones filtered once. The draws are a hash of the row's key, the unit's number,
the step and the seed: the same row gives the same pieces in every run and partitioning.

Spaces are kept as they are (no dummy prefix, nothing collapsed) and decoding joins the pieces' bytes, so it gives back the text
exactly. Nulls and edge cases: a null text has null pieces and decodes to null, an empty one has none; a null key draws as key 0 does not, but as
a key of its own; repeated rows are drawn alike; an empty table gives an empty result; lone surrogates can't occur in Spark strings; extra columns
pass through, one named like an output is replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import mix, small_batches

MODEL = "piece_bpe_32k.model"
_UNIT = re.compile(r"\n| *[^ \n]+| +")
_STEP, _UNIT_NO = np.uint64(0xD1342543DE82EF95), np.uint64(0x9E3779B97F4A7C15)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces as text with plain spaces, their weights, and the bytes of every id. Ids from ``size`` on stand for a
    character outside of the vocabulary until they are spelled out as bytes."""

    def __init__(self, path: str, temperature: float = 1.0):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.bytes, self.byte_id = m.vocab_size(), [], np.zeros(256, np.int32)
        step: dict[tuple[int, str], int] = {}
        piece_of, weight_of = [-1], [0.0]
        for i in range(self.size):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.bytes.append(b"")
            else:
                text, state = piece.replace("\u2581", " "), 0
                self.bytes.append(text.encode())
                for c in text:
                    state = step.setdefault((state, c), len(piece_of))
                    if state == len(piece_of):
                        piece_of.append(-1)
                        weight_of.append(0.0)
                piece_of[state], weight_of[state] = i, -math.log(3 + max(0.0, -m.get_score(i))) / temperature
        keys = np.array([(s << 21) | ord(c) for s, c in step], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array([*step.values()], np.int64)[order]
        self.piece_of, self.weight_of = np.array(piece_of, np.int32), np.array(weight_of)
        self.byte_weight = -math.log(self.size) / temperature

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def spelled(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with characters outside of the vocabulary as bytes, and how many each unit has then."""
        odd = np.flatnonzero(ids >= self.size)
        if not len(odd):
            return ids, count
        raw = [chr(c).encode() for c in (ids[odd] - self.size).tolist()]
        times = np.ones(len(ids), np.int64)
        times[odd] = [*map(len, raw)]
        out = np.repeat(ids, times)
        start = np.cumsum(times) - times
        for a, x in zip(start[odd], raw, strict=True):
            out[a : a + len(x)] = self.byte_id[list(x)]
        unit = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(unit, times, len(count)).astype(np.int64)


def lattices(v: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Filtered lattices of all units as flat arrays: the last node of each unit; for each node its first edge; for each edge the
    running probability among those of its node, its piece, and the node it comes from. Node 0 is where units start."""
    n = np.fromiter(map(len, units), np.int64, len(units))
    codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    off = np.cumsum(n) - n
    unit = np.repeat(np.arange(len(units)), n)
    at = np.arange(len(codes))
    depth, place = at - off[unit], at + unit
    left = n[unit] - depth
    whole = np.zeros(len(codes), bool)
    start, end, piece, weight, rank = [], [], [], [], []
    live, state, size = at, np.zeros(len(at), np.int64), 0
    while len(live):
        key = (state << 21) | codes[live + size]
        i = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        ok = v.keys[i] == key
        live, state, size = live[ok], v.next[i[ok]], size + 1
        is_piece = v.piece_of[state] >= 0
        a, s = live[is_piece], state[is_piece]
        if size == 1:
            whole[a] = True
        start.append(place[a])
        end.append(place[a] + size)
        rank.append(depth[a] + size)
        piece.append(v.piece_of[s])
        weight.append(v.weight_of[s])
        more = left[live] > size
        live, state = live[more], state[more]
    a = np.flatnonzero(~whole)
    c = codes[a]
    start.append(place[a])
    end.append(place[a] + 1)
    rank.append(depth[a] + 1)
    piece.append(np.where(c < 128, v.byte_id[np.minimum(c, 127)], v.size + c).astype(np.int32))
    weight.append((1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)) * v.byte_weight)
    # Longer pieces first: they are the likelier ones, and drawing looks at edges in order.
    start, end, rank, piece, weight = (np.concatenate(x[::-1]) for x in (start, end, rank, piece, weight))
    order = np.argsort(rank * (len(codes) + len(units) + 1) + end, kind="stable")
    start, end, rank, piece, weight = start[order], end[order], rank[order], piece[order], weight[order]
    new = np.ones(len(end), bool)
    new[1:] = end[1:] != end[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(end)))
    node_at = np.zeros(len(codes) + len(units) + 1, np.int64)
    node_at[end[first]] = np.arange(1, len(first) + 1)
    total, running = np.zeros(len(node_at)), np.zeros(len(end))
    turns = np.searchsorted(rank, np.arange(1, (rank[-1] if len(rank) else 0) + 2))
    nodes = np.searchsorted(first, turns)
    for a, z, p, q in zip(turns[:-1], turns[1:], nodes[:-1], nodes[1:], strict=True):
        if a == z:
            continue
        value, heads, k = total[start[a:z]] + weight[a:z], first[p:q] - a, count[p:q]
        top = np.maximum.reduceat(value, heads)
        x = np.exp(value - np.repeat(top, k))
        s = np.add.reduceat(x, heads)
        total[end[first[p:q]]] = top + np.log(s)
        run = np.cumsum(x)
        running[a:z] = (run - np.repeat(run[heads] - x[heads], k)) / np.repeat(s, k)
    running[first + count - 1] = 2.0
    return node_at[off + np.arange(len(units)) + n], np.concatenate([[0], first]), running, piece, node_at[start]


def sample(v: Vocabulary, units: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all units in order, and how many each has. ``seeds``: one of each unit."""
    index: dict[str, int] = {}
    which = np.fromiter((index.setdefault(u, len(index)) for u in units), np.int64, len(units))
    if not len(units):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    last, first, running, piece, back = lattices(v, [*index])
    live, at = np.arange(len(units)), last[which]
    who, what, count = [], [], np.zeros(len(units), np.int64)
    step = seeds.astype(np.uint64)
    while len(live):
        step = step + _STEP
        u = (mix(step) >> np.uint64(11)) * 2.0**-53
        edge = first[at]
        late = np.flatnonzero(running[edge] <= u)
        while len(late):
            edge[late] += 1
            late = late[running[edge[late]] <= u[late]]
        who.append(live)
        what.append(piece[edge])
        count[live] += 1
        at = back[edge]
        on = at > 0
        live, at, step = live[on], at[on], step[on]
    ends = np.cumsum(count)
    out = np.zeros(ends[-1], np.int32)
    for k, (w, x) in enumerate(zip(who, what, strict=True)):
        out[ends[w] - 1 - k] = x
    return v.spelled(out, count)


def encode_batch(v: Vocabulary, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
    """Sampled piece ids of each text; ``keys``: a 64-bit number of each row."""
    split = [_UNIT.findall(t) for t in texts]
    n = np.fromiter(map(len, split), np.int64, len(split))
    start = np.cumsum(n) - n
    number = (np.arange(n.sum()) - np.repeat(start, n)).astype(np.uint64)
    seeds = mix(np.repeat(mix(keys.astype(np.uint64)), n) + number * _UNIT_NO)
    ids, count = sample(v, [u for x in split for u in x], seeds)
    ends = np.concatenate([[0], np.cumsum(count)])
    return [ids[ends[a] : ends[a + k]] for a, k in zip(start, n, strict=True)]


def row_keys(values: list, seed: int) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(repr(v), seed) for v in values), np.uint64, len(values))


def encode(docs: DataFrame, *, path: str | None = None, seed: int = 1, temperature: float = 1.0, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Add ``pieces``, the sampled ids of each whole text, to ``docs``. With ``digest``, return instead ``key``, n_pieces, ids_crc32
    (of little-endian 32-bit ids), decoded_sha256 and lossless, so that ids needn't leave the worker."""
    small_batches(docs.sparkSession)
    path = path or model_path()
    kind = docs.schema[key].dataType
    names = [key] if digest else [c for c in docs.columns if c.lower() != "pieces"]
    docs = docs.select(*dict.fromkeys([*names, key, text]))
    more = [("n_pieces", T.LongType()), ("ids_crc32", T.LongType()), ("decoded_sha256", T.StringType()), ("lossless", T.BooleanType())] if digest else [("pieces", T.ArrayType(T.IntegerType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(path, temperature)
        for b in batches:
            texts = b.column(text).to_pylist()
            ids = encode_batch(v, [t or "" for t in texts], row_keys(b.column(key).to_pylist(), seed))
            if digest:
                back = [v.decode(x) for x in ids]
                gone = [t is None for t in texts]
                cols = [
                    pa.array([None if g else len(x) for x, g in zip(ids, gone, strict=True)], pa.int64()), pa.array([None if g else zlib.crc32(x.astype("<u4").tobytes()) for x, g in zip(ids, gone, strict=True)], pa.int64()),
                    pa.array([None if g else hashlib.sha256(x).hexdigest() for x, g in zip(back, gone, strict=True)], pa.string()), pa.array([None if t is None else x == t.encode() for x, t in zip(back, texts, strict=True)], pa.bool_()),
                ]
            else:
                cols = [pa.array([None if t is None else x for x, t in zip(ids, texts, strict=True)], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *cols], [*names, *(c for c, _ in more)])

    fields = [T.StructField(key, kind)] if digest else [docs.schema[c] for c in names]
    return docs.mapInArrow(run, T.StructType([*fields, *(T.StructField(c, t) for c, t in more)]))


def decode(docs: DataFrame, *, path: str | None = None, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """Add the text that ``pieces`` stand for; other columns pass through."""
    small_batches(docs.sparkSession)
    path = path or model_path()
    docs = docs.drop(out)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(path)
        for b in batches:
            texts = [None if x is None else b"".join(v.bytes[i] for i in x).decode("utf-8", "replace") for x in b.column(pieces).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())]))
