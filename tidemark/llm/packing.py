"""Best-fit packing of documents into sequences, after Martello-Toth dominance reduction.

Texts are tokenised and only longer ones are cut. How many pieces there are of each length, at most as many
numbers as a sequence has places, decides the whole packing, so it is planned once from that table: first every length, from the longest, is
given the set of partners that dominates all others for it, where one does; what is left goes to the fullest
sequence with room (best fit, longest first). The plan deals runs of equal pieces at once; pieces find their place by their rank among those
of equal length, which Spark counts in blocks.

Nulls and edge cases: a null or empty text is its end token alone; null ids and repeated rows are pieces like others; an
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, rank_in_blocks, small_batches

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
#: Words that a Python worker keeps at most, some 200 bytes each.
KEPT_WORDS = 1_000_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Token ids of a text as little-endian bytes. The vocabulary never joins what white space parts, so words are encoded
    apart and kept: those of late use survive when the younger of two tables is full and the older is dropped. Words not seen before reach
    the tokenizer many at a time, parted by a special token, whose id can't come from a word without its string."""

    def __init__(self, path: str, most: int = KEPT_WORDS, mark: str = "<|endoftext|>"):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks of a machine side by side
        from tokenizers import Tokenizer

        self._tokenizer, self._most, self._mark = Tokenizer.from_file(path), most // 2, mark
        self._mark_id = self._tokenizer.token_to_id(mark)
        self._young: dict[str, bytes] = {"": b""}
        self._old: dict[str, bytes] = {}
        self._stop, self._comma = (x.tobytes() for x in self._ids([".", ","]))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list[str]) -> None:
        young, mark = self._young, self._mark
        odd = [w for w in words if "<|" in w or "|>" in w]
        young.update(zip(odd, (x.tobytes() for x in self._ids(odd)), strict=True))
        plain = [w for w in words if w not in young] if odd else words
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        for group, ids in zip(groups, self._ids([mark.join(g) for g in groups]), strict=True):
            ends = [*(4 * np.flatnonzero(ids == self._mark_id)).tolist(), 4 * len(ids)]
            raw, a = ids.tobytes(), 0
            for w, z in zip(group, ends, strict=True):
                young[w] = raw[a:z]
                a = z + 4

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self._young) > self._most:
            self._old, self._young = self._young, {"": b""}
        young, old = self._young, self._old
        new = set().union(*split).difference(young)
        young.update((w, old[w]) for w in new if w in old)
        # The vocabulary is of lower case, and parts an ASCII letter or digit from a stop or comma: such words need encoding once.
        # Other letters may be normalised to a letter and a mark that isn't parted from the stop.
        bare = {}
        for w in new:
            if w not in young:
                x = w.lower() if w.isascii() else w
                bare[w] = (x[:-1], x[-1]) if len(x) > 1 and x[-1] in ".," and x[-2].isascii() and x[-2].isalnum() and "<|" not in x and "|>" not in x else (x if "<|" not in x and "|>" not in x else w, "")
        self._encode([x for x in {x for x, _ in bare.values()} if x not in young])
        tail = {"": b"", ".": self._stop, ",": self._comma}
        for w, (x, t) in bare.items():
            if w != x:
                young[w] = young[x] + tail[t]
        return [b"".join(map(young.__getitem__, words)) for words in split]


_TOKENIZERS: dict[tuple[str, int], WordTokenizer] = {}


def tokenizer(path: str, most: int = KEPT_WORDS) -> WordTokenizer:
    """One for each Python worker, which keeps its words from task to task."""
    if (path, most) not in _TOKENIZERS:
        _TOKENIZERS[path, most] = WordTokenizer(path, most)
    return _TOKENIZERS[path, most]


def pieces(docs: DataFrame, *, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", with_ids: bool = False, kept_words: int = KEPT_WORDS) -> DataFrame:
    """One row for each piece: key, piece, start, length, ids_crc32 and, on request, the ids."""
    small_batches(docs.sparkSession, *((1000, 16 << 20) if kept_words >= KEPT_WORDS else ()))  # larger ones meet fewer words twice
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, size = tokenizer(path, kept_words), bytes(4), 4 * capacity
        for b in batches:
            of, no, start, length, crc, ids = [], [], [], [], [], []
            for i, x in enumerate(encode([t or "" for t in b.column(1).to_pylist()])):
                x += end
                for p, a in enumerate(range(0, len(x), size)):
                    y = x[a : a + size]
                    of.append(i)
                    no.append(p)
                    start.append(a // 4)
                    length.append(len(y) // 4)
                    crc.append(zlib.crc32(y))
                    if with_ids:
                        ids.append(np.frombuffer(y, "<u4").astype(np.int32))
            cols = [b.column(0).take(pa.array(of, pa.int64())), pa.array(no, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays([*cols, *([pa.array(ids, pa.list_(pa.int32()))] * with_ids)], [key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


class _Plan:
    """Runs of equal pieces: ``length``, rank of the first, how many, first sequence, pieces in each, place in each."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left, self.used, self.runs, self.sequences, self.capacity = dict(counts), dict.fromkeys(counts, 0), [], 0, capacity

    def put(self, length: int, n: int, first: int, each: int, place: int) -> None:
        self.runs.append((length, self.used[length], n, first, each, place))
        self.used[length] += n
        self.left[length] -= n

    def fix(self, lengths: list[int]) -> int:
        """As many sequences of exactly these pieces as there are."""
        k = min(self.left[x] // lengths.count(x) for x in set(lengths))
        place = 0
        for x in lengths:
            self.put(x, k, self.sequences, 1, place)
            place += x
        self.sequences += k
        return k


def _dominant(have: list[int], left: dict[int, int], length: int, capacity: int) -> list[int] | None:
    """The set of pieces with one of ``length`` that dominates all others, if the criteria find one. ``have``: the lengths that are left, ascending."""
    room = capacity - length
    spare = lambda x: left[x] - (x == length)

    def largest(most: int, taken: tuple[int, ...] = ()) -> int:
        i = bisect_right(have, most) - 1
        while i >= 0 and spare(have[i]) - taken.count(have[i]) <= 0:
            i -= 1
        return have[i] if i >= 0 else 0

    one = largest(room)
    if not one or one == room:
        return [length, one] if one else [length]
    small: list[int] = []
    for x in have:
        small += [x] * min(3 - len(small), max(0, spare(x)))
        if len(small) == 3:
            break
    if len(small) < 2 or small[0] + small[1] > room:
        return [length, one]
    two = largest(room - one, (one,))
    if not two or (len(small) == 3 and sum(small) <= room):
        return None
    i = bisect_right(have, room // 2) - 1
    while i >= 0:  # the largest that can be the smaller of a pair
        y = have[i]
        if spare(y) > 0 and largest(room - y, (y,)) >= y:
            return [length, one, two] if y <= two else None
        i -= 1
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs and the number of sequences for a table of lengths. Its work depends on the number of lengths alone."""
    p = _Plan({k: n for k, n in counts.items() if n}, capacity)
    have, changed = sorted(p.left), True
    while changed:
        changed = False
        for length in sorted(have, reverse=True):
            while p.left[length] > 0 and (s := _dominant(have, p.left, length, capacity)) and p.fix(s):
                changed = True
                have = [x for x in have if p.left[x] > 0]
            if not have:
                break
        have = [x for x in have if p.left[x] > 0]
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def add(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in free:
                insort(rooms, room)
                free[room] = []
            free[room].append((first, n))

    for length in sorted(have, reverse=True):
        while (n := p.left[length]) > 0:
            i = bisect_right(rooms, length - 1)
            if i == len(rooms):
                each = min(n, capacity // length)
                room, first, bins = capacity, p.sequences, n // each
                p.sequences += bins
            else:
                room = rooms[i]
                first, bins = free[room].pop()
                if not free[room]:
                    del free[room], rooms[i]
                each = min(n, room // length)
                take = min(bins, n // each)
                add(room, first + take, bins - take)
                bins = take
            p.put(length, bins * each, first, each, capacity - room)
            add(room - each * length, first, bins)
    return p.runs, p.sequences


def pack(rows: DataFrame, *, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to pieces (key, piece, start, length, ids_crc32)."""
    rows = cut(rows)
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs = np.array(sorted(plan(counts, capacity)[0]), dtype=np.int64).reshape(-1, 6)
    starts = (runs[:, 0] << 44) + runs[:, 1]
    ranked = rank_in_blocks(rows, "length", F.xxhash64(key, "piece", "ids_crc32"), [key, "piece", "ids_crc32"], "rank")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            r = runs[np.searchsorted(starts, (length << 44) + rank, side="right") - 1] if len(length) else runs[:0]
            i = rank - r[:, 1]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(r[:, 3] + i // np.maximum(r[:, 4], 1)), pa.array(r[:, 5] + i % np.maximum(r[:, 4], 1) * length)], [*names, "sequence_id", "offset"])

    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*names, "rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", kept_words: int = KEPT_WORDS) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return pack(pieces(docs, path=path or vocabulary_path(), capacity=capacity, key=key, text=text, kept_words=kept_words), capacity=capacity, key=key)
