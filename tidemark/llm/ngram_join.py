"""Exact Jaccard self-join on word 5-grams by vertical partitioning, and its connected components.

The global order of n-grams (frequent ones last, else by hash) is cut into fragments. Candidates: in their fragments, the
first ``n - ceil(0.75 n) + 1`` n-grams of each set, its prefix, meet those of others; two sets that link share one of
them. The n-grams that two texts share there are counted in each fragment and summed per pair: sets whose
prefixes share too few can't link. Verification: the whole sets are cut into fragments of the hash order too; each fragment counts its
part of a pair's overlap, and the counts are summed per pair.

Groups of copies cost stars and not all pairs. Each text is first compared with the hub that it shares most with, and texts that many
others of other components share n-grams with are compared with the hub of those. What is left are members of a bucket in different components. They are a
candidate only where all bounds allow it: their sizes, the places of what they share, how many n-grams either
can share at all, and the overlaps of both with a common hub, outside of which they share at most what either has left. No link
between components is lost. (An n-gram of a prefix that another text has lies in that one's prefix too, if that ends behind it; so n-grams of a prefix that
meet nothing are shared with no text whose prefix ends behind the last of them.)

Which n-grams count as frequent is an order only, found over all documents; any order gives the same links. N-grams are compared by 64-bit hashes.

Nulls and edge cases: a null text, or one without words, has an empty set and links with nothing; its component is its own
id. Rows of equal word sequences are one node, so repeated rows and ids are fine; a component's id is the smallest id of its rows,
null where none has one. An empty table gives an empty result. Extra columns are ignored by ``near_duplicates`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, copied, distinct_sets, hot_keys, mix, parts, remove, small_batches, spread, words_of, written

PERCENT = 75
#: N-grams known as frequent, at most: 6 MB for each worker.
MOST_FREQUENT = 1 << 19
FREQUENT_FROM = 8
#: N-grams of one fragment, on average, and n-grams held in memory before they are dealt out.
FRAGMENT, HELD = 750_000, 500_000
#: Holders of one n-gram that meet in one group; those of a more frequent one are dealt over several.
HOLDERS = 50_000
#: Bits of the filter that tells which texts take part in a pair (2 MB). Beyond its capacity more texts are read, none is lost.
FILTER_BITS = 1 << 24
#: Fragments of the verification; rows of one bucket, or partners of one hub, that one task takes together.
VERIFY_FRAGMENTS, SALT_ROWS = 4, 1_000
#: A text with more candidates than this in open buckets is compared with their hub first.
BUSY = 64
_CUTS = np.arange(1, VERIFY_FRAGMENTS, dtype=np.uint64) * np.uint64(2**64 // VERIFY_FRAGMENTS)


def unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, "<u8").astype(np.uint64)


def _words(b: pa.RecordBatch) -> list[list[bytes]]:
    return [words_of(t) if t else [] for t in b.column(0).to_pylist()]


def _node(words: list[bytes]) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(words))).view(np.int64))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams that many texts of a partition hold twice or more; any that more texts hold than there are partitions is among them. Rows without an n-gram
    tell how many there are in all, and texts."""
    hasher, held, n, texts = WordHasher(), [], 0, 0

    def out() -> pa.RecordBatch:
        x = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, int)
        count = np.diff(np.append(at, len(x)))
        keep = count > 1
        token, many = pa.array(np.append(x[at][keep].view(np.int64), [0, 0]), mask=np.append(~keep[keep], [True, True])), np.append(count[keep], [len(x), texts])
        return pa.RecordBatch.from_arrays([token, pa.array(many, pa.int64()), pa.array(np.append(np.zeros(len(token) - 1, bool), True))], ["token", "n", "texts"])

    for b in batches:
        texts += b.num_rows
        for s in distinct_sets(_words(b), hasher):
            held.append(s)
            n += len(s)
            if n > HELD:
                yield out()
                held, n, texts = [], 0, 0
    yield out()


def frequent(texts: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], int, int]:
    """The most frequent n-grams of the corpus, at most :data:`MOST_FREQUENT`, sorted, with their counts; how many n-grams texts hold in all; and how many texts there are."""
    n = texts.mapInArrow(_repeated, "token long, n long, texts boolean").groupBy("token", "texts").agg(F.sum("n").alias("n")).where(F.col("token").isNull() | (F.col("n") >= FREQUENT_FROM))
    paths: list[str] = []
    n = written(n.withColumn("grade", (F.log2("n") * 4).cast("int")), paths)
    sums = {r["texts"]: r["n"] for r in n.where("token is null").collect()}
    n, least, room = n.where("token is not null"), 0, MOST_FREQUENT
    for r in n.groupBy("grade").count().orderBy(F.desc("grade")).collect():  # some 150 rows
        room -= r["count"]
        if room < 0:
            least = r["grade"] + 1
            break
    rows = n.where(F.col("grade") >= least).select("token", "n").toArrow()
    remove(texts.sparkSession, paths[0])
    token, count = rows.column("token").to_numpy().view(np.uint64), np.minimum(rows.column("n").to_numpy(), 2**31 - 1).astype(np.int32)
    order = np.argsort(token)
    return (token[order], count[order]), sums.get(False, 0), sums.get(True, 0)


def _pieces(order, t: np.ndarray) -> np.ndarray:
    """Over how many groups the holders of each n-gram are dealt."""
    tokens, counts = order.value
    hot = counts > HOLDERS
    tokens, counts = tokens[hot], counts[hot]
    if not len(tokens):
        return np.ones(len(t), np.int64)
    at = np.minimum(np.searchsorted(tokens, t), len(tokens) - 1)
    return np.where(tokens[at] == t, -(-counts[at].astype(np.int64) // HOLDERS), 1)


def _in_order(order, t: np.ndarray) -> np.ndarray:
    """The places of n-grams in the global order, as numbers that never invert it; those of n-grams that aren't frequent are below 2^32."""
    tokens, counts = order.value
    rank = np.zeros(len(t), np.int64)
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, t), len(tokens) - 1)
        rank = np.where(tokens[at] == t, counts[at], 0).astype(np.int64)
    return (rank << 32) + (t >> np.uint64(32)).astype(np.int64)


def _short(one: np.ndarray, count: np.ndarray, most: int = 65_535) -> tuple[np.ndarray, np.ndarray]:
    """``count`` in two bytes each: one of more than ``most`` becomes several of the same ``one``."""
    k = -(-count // most)
    left = np.full(k.sum(), most, np.int64)
    left[np.cumsum(k) - 1] = count - (k - 1) * most
    return np.repeat(one, k), left.astype(np.uint16)


#: What is dealt: fragments' parts of prefixes, and, with a null in their place, the rows of the table.
DEALT = "fragment int, tokens binary, nodes binary, counts binary, places binary, id {0}, also long, node long, n long, end long"
MET = "bucket long, node long, far long, w long, place long, id {0}, also long, n long, end long, own boolean"


def _deal(fragments: int, order):
    """Rows (fragment, its n-grams, nodes, n-grams of each node, their places in it) from many prefixes at a time, and a row for each text: its ids, its node, the size of its
    set and, once a task for each node, its prefix's end, which is the place of its last n-gram in the global order. A node is named in each of the fragments that
    its prefix falls into, more of them the larger the table is; what else is known of it is joined later. Prefixes are stored nowhere else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (tokens, counts), seen = WordHasher(), order.value, set()
        prefixes, nodes, held, rows = [], [], 0, 0

        def batch(count: int, kind: pa.DataType, **cols) -> pa.RecordBatch:
            kinds = {"fragment": pa.int32(), **dict.fromkeys(("tokens", "nodes", "counts", "places"), pa.binary()), "id": kind, **dict.fromkeys(("also", "node", "n", "end"), pa.int64())}
            return pa.RecordBatch.from_arrays([pa.nulls(count, t) if c not in cols else cols[c] if isinstance(cols[c], pa.Array) else pa.array(cols[c], t) for c, t in kinds.items()], [*kinds])

        def out(kind: pa.DataType) -> pa.RecordBatch:
            t = np.concatenate(prefixes)
            of = np.repeat(np.arange(len(nodes)), [len(x) for x in prefixes])
            place = np.concatenate([np.minimum(np.arange(len(x)), 65_535) for x in prefixes]).astype(np.uint16)
            node = np.array(nodes, np.int64)
            own = mix(node.view(np.uint64))[of] % _pieces(order, t).astype(np.uint64)
            f = ((mix(t) + own) % np.uint64(fragments)).astype(np.int64)
            by = np.argsort(f, kind="stable")
            t, of, f, place = t[by], of[by], f[by], place[by]
            ends, made = np.searchsorted(f, np.arange(fragments + 1)), []
            for k in range(fragments):
                a, z = ends[k], ends[k + 1]
                if a < z:
                    one, count = _short(*np.unique(of[a:z], return_counts=True))
                    made.append((k, t[a:z].astype("<u8").tobytes(), node[one].tobytes(), count.tobytes(), place[a:z].tobytes()))
            return batch(len(made), kind, **dict(zip(("fragment", "tokens", "nodes", "counts", "places"), zip(*made, strict=True), strict=True)))

        for b in batches:
            words = _words(b)
            node, size, last = [], [], []
            for w, s in zip(words, distinct_sets(words, hasher), strict=True):
                n = len(s)
                x = _node(w) if n else None
                node.append(x)
                size.append(n)
                if not n or x in seen:
                    last.append(None)
                    continue
                seen.add(x)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    rank = np.where(tokens[at] == s, counts[at], 0)
                    if rank.any():
                        s = s[np.argsort(rank, kind="stable")]
                s = s[: n - -(-n * PERCENT // 100) + 1]
                last.append(int(_in_order(order, s[-1:])[0]))
                prefixes.append(s)
                nodes.append(x)
                held += len(s)
            dealt = np.arange(rows, rows + b.num_rows) % fragments
            yield batch(b.num_rows, b.column(1).type, fragment=dealt, id=b.column(1), also=b.column(2), node=node, n=size, end=last)
            rows += b.num_rows
            if held > HELD:
                yield out(b.column(1).type)
                prefixes, nodes, held = [], [], 0
        if nodes:
            yield out(b.column(1).type)

    return run


def _met(order):
    """:func:`_meet` of the parts of a fragment; the rows of the table that were dealt to it are passed on as ``own``."""
    names = ["bucket", "node", "far", "w", "place", "id", "also", "n", "end", "own"]

    def run(rows: pa.Table) -> pa.Table:
        kinds = [pa.int64()] * 5 + [rows.column("id").type] + [pa.int64()] * 3 + [pa.bool_()]
        part = pa.compute.is_valid(rows.column("tokens"))
        own, parts = rows.filter(pa.compute.invert(part)), rows.filter(part)
        found = [own.append_column("own", pa.array(np.ones(len(own), bool)))]
        if len(parts):
            found.append(_meet(order, parts))
            found[1] = found[1].append_column("own", pa.array(np.zeros(len(found[1]), bool)))
        cols = lambda t: [t.column(c).cast(k) if c in t.column_names else pa.chunked_array([pa.nulls(len(t), k)]) for c, k in zip(names, kinds, strict=True)]
        return pa.concat_tables([pa.table(cols(t), names=names) for t in found])

    return run


def _meet(order, rows: pa.Table) -> pa.Table:
    """Within one fragment: rows (bucket, node, n-grams, first place) of the nodes that share n-grams. N-grams that the same nodes
    share are one bucket, named by the hash of its nodes, so that equal buckets of several fragments are one too; an n-gram
    whose holders were dealt over several groups is named by its own hash, and all its holders are given. Rows without a bucket tell ``far``, the place of the last
    frequent n-gram that a node alone has."""
    import xxhash

    cat = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in rows.column(c).to_pylist()])
    t, node, place = unpacked(b"".join(rows.column("tokens").to_pylist())), np.repeat(cat("nodes", np.int64), cat("counts", np.uint16)), cat("places", np.uint16)
    by = np.argsort(t, kind="stable")
    t, node, place = t[by], node[by], place[by]
    same, split = t[1:] == t[:-1], _pieces(order, t) > 1
    shared = split.copy()
    shared[1:] |= same
    shared[:-1] |= same
    t1, n1 = t[~shared], node[~shared]
    t, node, place, split = t[shared], node[shared], place[shared], split[shared]
    by = np.lexsort((node, t))
    t, node, place, split = t[by], node[by], place[by], split[by]
    keep = np.ones(len(t), bool)
    keep[1:] = (t[1:] != t[:-1]) | (node[1:] != node[:-1])
    t, node, place, split = t[keep], node[keep], place[keep], split[keep]
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, int)
    length = np.diff(np.append(first, len(t)))
    # Equal texts that several tasks read are rows of one node, which alone has the n-gram.
    one = first[(length < 2) & ~split[first]]
    lone, alone = np.concatenate([n1, node[one]]), _in_order(order, np.concatenate([t1, t[one]]))
    lone, alone = lone[alone >= 1 << 32], alone[alone >= 1 << 32]
    by = np.lexsort((-alone, lone))
    lone, alone = lone[by], alone[by]
    last = np.flatnonzero(np.concatenate([[True], lone[1:] != lone[:-1]])) if len(lone) else np.zeros(0, int)
    big: dict[bytes, list[int]] = {}
    for s, k in zip(first.tolist(), length.tolist(), strict=True):
        if k < 2 and not split[s]:
            continue
        h = t[s : s + 1].tobytes() if split[s] else node[s : s + k].tobytes()
        if h in big:
            a = big[h][0]
            np.minimum(place[a : a + k], place[s : s + k], out=place[a : a + k])
            big[h][2] += 1
        else:
            big[h] = [s, k, 1]
    spans = np.array([*big.values()], np.int64).reshape(-1, 3)
    name = np.fromiter((xxhash.xxh3_64_intdigest(h) for h in big), np.uint64, len(big)).view(np.int64)
    pick = np.concatenate([np.arange(s, s + k) for s, k, _ in spans]) if len(spans) else np.zeros(0, int)
    cols = [np.repeat(name, spans[:, 1]), node[pick], pa.nulls(len(pick), pa.int64()), np.repeat(spans[:, 2], spans[:, 1]), place[pick].astype(np.int64)]
    none = np.zeros(len(last), np.int64)
    more = [pa.nulls(len(last), pa.int64()), lone[last], alone[last], none, none]
    long = lambda x: x if isinstance(x, pa.Array) else pa.array(x, pa.int64())
    return pa.table([pa.chunked_array([long(c), long(x)]) for c, x in zip(cols, more, strict=True)], names=["bucket", "node", "far", "w", "place"])


def _bits(nodes: np.ndarray) -> np.ndarray:
    h = mix(nodes.view(np.uint64))
    return np.stack([h % np.uint64(FILTER_BITS), (h >> np.uint64(32)) % np.uint64(FILTER_BITS)]).astype(np.int64)


def _node_filter(nodes: DataFrame) -> np.ndarray:
    """Bit array of a fixed size that holds every node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(FILTER_BITS // 8, np.uint8)
        for b in batches:
            at = _bits(b.column(0).to_numpy()).ravel()
            np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at].astype(np.int64))], ["at", "bits"])

    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    rows = nodes.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most FILTER_BITS / 8 rows
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint8)
    return bits


def _segments(wanted):
    """(node, fragment, its n-grams) of the texts that may take part in a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits, seen = WordHasher(), wanted.value, set()
        for b in batches:
            words = [w for w in _words(b) if w]
            if not words:
                continue
            nodes = np.array([_node(w) for w in words], np.int64)
            at = _bits(nodes)
            hit = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)
            pick = []
            for i in np.flatnonzero(hit).tolist():
                if nodes[i] not in seen:
                    seen.add(nodes[i])
                    pick.append(i)
            if pick:
                cuts = [s for x in distinct_sets([words[i] for i in pick], hasher) for s in np.split(x, np.searchsorted(x, _CUTS))]
                cols = [pa.array(np.repeat(nodes[pick], VERIFY_FRAGMENTS)), pa.array(np.tile(np.arange(VERIFY_FRAGMENTS, dtype=np.int32), len(pick))), pa.array([s.astype("<u8").tobytes() for s in cuts], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["node", "fragment", "tokens"])

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, node, overlap) within one fragment: the first row of each (key, salt, fragment) is the hub's. A text that several tasks
    read comes several times in a row and counts once."""
    last, hub, mine, before = None, None, np.zeros(0, np.uint64), None
    for x in batches:
        a, b, k = [], [], []
        for key, salt, fragment, node, tokens in zip(*(x.column(i).to_pylist() for i in range(5)), strict=True):
            if (key, salt, fragment) != last:
                last, hub, mine, before = (key, salt, fragment), node, unpacked(tokens), node
            elif node != before:
                before = node
                a.append(hub)
                b.append(node)
                k.append(len(np.intersect1d(mine, unpacked(tokens), assume_unique=True)))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, k)], ["a", "b", "k"])


def overlaps_of(pairs: DataFrame, texts: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """(a, b, k) with the exact overlap of each pair (a, b). In each fragment the n-grams of each ``b`` go to those of ``a``, in parts
    where ``a`` has many; partial overlaps are summed per pair. What is written for it is added to ``paths``."""
    spark = pairs.sparkSession
    dealt = spread(pairs.select("a", "b"), "a", hot_keys(pairs, "a", SALT_ROWS), F.col("b"))
    own = dealt.select("a", "_salt").distinct().select(F.col("a").alias("key"), "_salt", F.lit(0).alias("rank"), F.col("a").alias("node"))
    where = written(own.unionByName(dealt.select(F.col("a").alias("key"), "_salt", F.lit(1).alias("rank"), F.col("b").alias("node"))), paths)
    wanted = spark.sparkContext.broadcast(_node_filter(where.select("node").distinct()))
    sets = where.join(texts.mapInArrow(_segments(wanted), "node long, fragment int, tokens binary"), "node")
    sets = sets.repartition(4 * parts(spark), "key", "_salt", "fragment").sortWithinPartitions("key", "_salt", "fragment", "rank", "node")
    partial = sets.select("key", "_salt", "fragment", "node", "tokens").mapInArrow(_overlaps, "a long, b long, k long")
    return partial.groupBy("a", "b").agg(F.sum("k").alias("k"))


def components(links: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """(node, component): the smallest node reachable. Labels fall to neighbours' minima, a node that is a label falls with the lowest of those that
    had it (so whole trees move at once, and long chains take a logarithm of rounds), and then all fall to their label's label. A round's labels
    are removed when the next are written; the last ones' path is added to ``paths``."""
    spark, own, rounds = links.sparkSession, [], []
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    hot = written(hot_keys(both, "b", SALT_ROWS), own)
    both = written(spread(both, "b", hot, F.col("a")), own)
    label = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")), rounds)
    while True:
        near = both.join(copied(label.select(F.col("a").alias("b"), "c"), "b", hot), ["b", "_salt"]).groupBy("a").agg(F.min("c").alias("near"))
        down = written(label.join(near, "a").select("a", F.col("c").alias("old"), F.least("c", "near").alias("c")), rounds)
        hook = down.groupBy(F.col("old").alias("a")).agg(F.min("c").alias("hook"))
        down = written(down.join(hook, "a", "left").select("a", "old", F.least("c", F.coalesce("hook", "c")).alias("c")), rounds)
        few = hot_keys(down, "c", SALT_ROWS)
        up = copied(down.select(F.col("a").alias("c"), F.col("c").alias("up")), "c", few)
        new = written(spread(down, "c", few, F.col("a")).join(up, ["c", "_salt"], "left").select("a", "old", F.least(F.col("c"), F.coalesce("up", "c")).alias("c")), rounds)
        done = not new.where("old != c").limit(1).count()
        label = new.select("a", "c")
        for path in rounds[:-1] + own * done:
            remove(spark, path)
        rounds = rounds[-1:]
        if done:
            if paths is not None:
                paths += rounds
            return label.select(F.col("a").alias("node"), F.col("c").alias("component"))


def _need(n: Column, m: Column) -> Column:
    """The overlap from which sets of n and m n-grams link."""
    return F.ceil(PERCENT * (n + m) / (100 + PERCENT))


def _possible(k, n, m):
    """Whether sets of n and m n-grams that share k of their prefixes can link: all that they share lies in both
    prefixes or behind the one that ends first."""
    behind = lambda x: F.ceil(x * PERCENT / 100) - 1
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (k + F.greatest(behind(n), behind(m)) >= _need(n, m))


def _with_shared(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """The buckets with the size ``n`` and the ``end`` of their ``nodes``, and with ``e``, how many of a node's n-grams a text may have whose prefix ends behind ``lone``: those of the prefix that are in no
    bucket it can't have. ``lone`` is a bound of the place of the last of these."""
    own = met.groupBy("node").agg(F.sum("w").alias("inside"), F.max("far").alias("far")).where("inside > 0").join(nodes, "node")
    own = own.select("node", "n", "end", (F.ceil(F.col("n") * PERCENT / 100) - 1 + F.col("inside")).alias("e"), F.least("end", F.coalesce("far", F.lit((1 << 32) - 1))).alias("lone"))
    return met.where("bucket is not null").drop("far").join(own, "node")


def _to_hubs(buckets: DataFrame, hubs: DataFrame) -> DataFrame:
    """Each row of ``buckets`` with its bucket's row of ``hubs``; large buckets are dealt over several tasks."""
    salts = F.ceil(F.col("holders") / SALT_ROWS).cast("int")
    rows = buckets.withColumn("_salt", F.pmod(F.xxhash64("node"), salts).cast("int"))
    return rows.join(hubs.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("holders"), ["bucket", "_salt"])


def _stars(buckets: DataFrame) -> DataFrame:
    """(a, m, z, b, n): for each node b the hub a that it shares most n-grams with, their sizes, and the end of a. The hub of a bucket is its node with the
    largest share of n-grams that others have: of a group of copies the one that was changed least."""
    hubs = buckets.groupBy("bucket").agg(F.max(F.struct(F.col("e") / F.col("n"), "node", "n", "e", "end")).alias("h"), F.max("holders").alias("holders"))
    hubs = hubs.select("bucket", "holders", F.col("h.node").alias("a"), F.col("h.n").alias("m"), F.col("h.end").alias("z"))
    pairs = _to_hubs(buckets, hubs).where("node != a").groupBy(F.col("node").alias("b"), "n", "a", "m", "z").agg(F.sum("w").alias("k"))
    pairs = pairs.where(_possible(F.col("k"), F.col("n"), F.col("m")))
    return pairs.groupBy("b", "n").agg(F.max(F.struct("k", "a", "m", "z")).alias("h")).select("h.a", "h.m", "h.z", "b", "n")


def _compared(pairs: DataFrame, texts: DataFrame, paths: list[str]) -> DataFrame:
    """``pairs`` (a, m, z, b, n) with their overlap ``o`` and whether they link."""
    o = pairs.join(overlaps_of(pairs, texts, paths).withColumnRenamed("k", "o"), ["a", "b"], "left").fillna(0, ["o"])
    return written(o.withColumn("linked", F.col("o") >= _need(F.col("n"), F.col("m"))), paths)


def _open(buckets: DataFrame, done: DataFrame, paths: list[str]) -> DataFrame:
    """The buckets whose nodes are in several components, with each node's component ``c`` as far as ``done`` tells, its overlap ``o``
    with its hub, and ``out``, what it may share outside of the hub with a text whose prefix ends behind its lone n-grams; the hub of one that was compared with none is itself if it is one. A hub's rank is above those it was chosen for,
    so the links to hubs are a forest, and two steps towards its roots do for now."""
    up = done.where("linked").select(F.col("b").alias("node"), F.col("a").alias("c"))
    for _ in range(2):
        hot = hot_keys(up, "c", SALT_ROWS)
        over = copied(up.select(F.col("node").alias("c"), F.col("c").alias("top")), "c", hot)
        up = written(spread(up, "c", hot, F.col("node")).join(over, ["c", "_salt"], "left").select("node", F.coalesce("top", "c").alias("c")), paths)
    hubs = done.select(F.col("a").alias("node"), F.col("a").alias("hub"), F.col("m").alias("o"), "z", F.lit(0).alias("rank")).distinct()
    hubs = hubs.unionByName(done.select(F.col("b").alias("node"), F.col("a").alias("hub"), "o", "z", F.lit(1).alias("rank")))
    hubs = hubs.groupBy("node").agg(F.max(F.struct("rank", "hub", "o", "z")).alias("x")).select("node", "x.hub", "x.o", "x.z")
    rows = buckets.drop("c", "hub", "o", "out").join(up, "node", "left").join(hubs, "node", "left").withColumn("c", F.coalesce("c", "node"))
    # What a node shares with a hub whose prefix ends behind its lone n-grams is among its ``e``.
    rows = rows.withColumn("out", F.when(F.col("z") > F.col("lone"), F.col("e")).otherwise(F.col("n")) - F.col("o")).drop("z")
    several = rows.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("now"), F.max("holders").alias("holders")).where("lo != hi").drop("lo", "hi")
    return written(_to_hubs(rows, several).drop("_salt", "holders").withColumnRenamed("now", "holders"), paths)


def _busy(buckets: DataFrame) -> DataFrame:
    """(a, b, n): nodes not compared yet that share buckets with many others of like size, and the hub of most of those."""
    rows = buckets.withColumn("class", F.floor(F.log("n") / F.log(F.lit(100 / PERCENT))))
    like = rows.groupBy("bucket", "class", "hub").agg(F.count("*").alias("k"), F.max("holders").alias("holders"))
    like = like.groupBy("bucket", "class").agg(F.sum("k").alias("others"), F.max(F.when(F.col("hub").isNotNull(), F.struct("k", "hub"))).alias("h"), F.max("holders").alias("holders"))
    like = like.where("others > 1").select("bucket", F.col("class").alias("of"), "others", F.col("h.hub").alias("a"), "holders")
    rows = _to_hubs(rows.where("hub is null").drop("hub"), like).where("class = of")
    best = rows.groupBy("node", "n", "a").agg(F.sum("w").alias("k"), F.sum(F.col("others") - 1).alias("others"))
    best = best.groupBy("node", "n").agg(F.sum("others").alias("others"), F.max(F.when(F.col("a").isNotNull(), F.struct("k", "a"))).alias("h"))
    return best.where((F.col("others") > BUSY) & F.col("h").isNotNull()).select("h.a", F.col("node").alias("b"), "n")


def _rest(buckets: DataFrame) -> DataFrame:
    """(a, m, z, b, n): pairs of a bucket in different components that all bounds allow. Of the n-grams that a pair must share, the first ``some`` lie
    within the first n - need + some places of both prefixes."""
    side = lambda q, s: buckets.select("bucket", *(F.col(c).alias(c + s) for c in ("node", "n", "end", "e", "lone", "c", "hub", "o", "out", "place")), *q)
    salts = F.ceil(F.col("holders") / SALT_ROWS).cast("int")
    x, y = side(["w", F.pmod(F.xxhash64("node"), salts).cast("int").alias("_salt")], "1"), side([F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")], "2")
    n, m, o, p = (F.col(c) for c in ("n1", "n2", "o1", "o2"))
    larger, smaller, need = F.greatest(n, m), F.least(n, m), _need(n, m)
    some = F.greatest(F.lit(1), F.least(1 + F.floor(smaller / 50), need - F.ceil(PERCENT * larger / 100) + 1))
    near = (F.col("node1") < F.col("node2")) & (F.col("c1") != F.col("c2")) & (100 * smaller >= PERCENT * larger) & (F.col("place1") < n - need + some) & (F.col("place2") < m - need + some)
    known1, known2 = F.col("lone1") < F.col("end2"), F.col("lone2") < F.col("end1")
    near = near & (F.least(F.when(known1, F.col("e1")).otherwise(n), F.when(known2, F.col("e2")).otherwise(m)) >= need) & ~F.coalesce((F.col("hub1") == F.col("node2")) | (F.col("hub2") == F.col("node1")), F.lit(False))
    left = F.least(F.when(known1, F.col("out1")).otherwise(n - o), F.when(known2, F.col("out2")).otherwise(m - p))
    near = near & F.coalesce((F.col("hub1") != F.col("hub2")) | (F.least(o, p) + left >= need), F.lit(True))
    pairs = x.join(y, ["bucket", "_salt"]).where(near).groupBy(F.col("node1").alias("a"), F.col("node2").alias("b"), F.col("n1").alias("m"), F.col("n2").alias("n"), F.col("end1").alias("z")).agg(F.sum("w").alias("k"), F.max(some).alias("some"))
    return pairs.where("k >= some").select("a", "m", "z", "b", "n")


def _links(buckets: DataFrame, texts: DataFrame, paths: list[str]) -> DataFrame:
    """Links (a, b) that connect all that is connected. What they are read from is added to ``paths``."""
    done = _compared(written(_stars(buckets), paths), texts, paths)
    buckets = _open(buckets, done, paths)
    sizes = buckets.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("end").alias("z")).distinct()
    known = done.select("a", "m", "z").unionByName(sizes).distinct()
    busy = written(_busy(buckets).join(known, "a"), paths)
    if busy.limit(1).count():
        done = written(done.unionByName(_compared(busy, texts, paths).select(*done.columns)), paths)
        buckets = _open(buckets, done, paths)
    links = done.where("linked").select("a", "b")
    rest = written(_rest(buckets), paths)
    if rest.limit(1).count():
        links = links.unionByName(_compared(rest, texts, paths).where("linked").select("a", "b"))
    return links


def _grouped(texts: DataFrame) -> DataFrame:
    """(id, also, n, c, least) of each row of ``texts`` (text, id, also): the size of its set, its component (null without
    words), and the component's smallest id."""
    spark = texts.sparkSession
    small_batches(spark)
    order, total, count = frequent(texts.select("text"))
    order, kind = spark.sparkContext.broadcast(order), texts.schema["id"].dataType.simpleString()
    fragments = max(parts(spark), int((total * (100 - PERCENT) // 100 + count) // FRAGMENT) + 1)
    paths: list[str] = []
    dealt = texts.select("text", "id", "also").mapInArrow(_deal(fragments, order), DEALT.format(kind))
    both = written(dealt.groupBy("fragment").applyInArrow(_met(order), MET.format(kind)), paths)
    rows = written(both.where("own").select("id", "also", "node", "n"))
    known = written(both.where("own and end is not null").groupBy("node").agg(F.max("n").alias("n"), F.max("end").alias("end")), paths)
    met = written(both.where("not own").groupBy("bucket", "node").agg(F.max("far").alias("far"), F.sum("w").alias("w"), F.min("place").alias("place")), paths)
    remove(spark, paths.pop(0))
    buckets = written(_with_shared(met, known), paths)
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("holders")).where("holders > 1")
    buckets = written(buckets.join(sizes, "bucket"), paths)
    links = _links(buckets, texts.select("text"), paths)
    pairs: list[str] = []
    links = written(links, pairs)
    for path in paths:
        remove(spark, path)
    part = components(links, pairs)

    nodes = written(rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("_rows")))
    linked = written(part.join(nodes, "node").select("node", "component", "least"))
    for path in pairs:
        remove(spark, path)
    big = hot_keys(linked, "component", SALT_ROWS)
    least = copied(linked.groupBy("component").agg(F.min("least").alias("of")), "component", big)
    linked = spread(linked, "component", big, F.col("node")).join(least, ["component", "_salt"]).select("node", "component", "of")
    nodes = nodes.join(linked, "node", "left").select("node", "_rows", F.coalesce("component", "node").alias("c"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("of")).alias("least"))
    hot = hot_keys(nodes, "node", 2 * SALT_ROWS, counts="_rows")
    full = spread(rows.where("node is not null"), "node", hot, F.col("id"), F.col("also")).join(copied(nodes.drop("_rows"), "node", hot), ["node", "_salt"])
    none = rows.where("node is null").withColumns({"c": F.lit(None).cast("long"), "least": F.lit(None).cast(kind)})
    return full.select("id", "also", "n", "c", "least").unionByName(none.select("id", "also", "n", "c", "least"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_shingles and component_id of every row of ``docs``."""
    rows = _grouped(docs.select(F.col(text).alias("text"), F.col(key).alias("id"), F.lit(0).cast("long").alias("also")))
    return rows.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (a null id only where no row has one); of rows
    without words, one of each id and text. All columns stay."""
    kept = "__kept" + "_" * sum(map(len, docs.columns))
    named = lambda k, h: F.concat(F.when(k.isNull(), "-").otherwise("+"), F.coalesce(k.cast("string"), F.lit("")), F.lit(":"), h.cast("string")).alias(kept)
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = _grouped(docs.select(F.col(text).alias("text"), F.col(key).alias("id"), hashed.alias("also")))
    first = rows.where("c is not null").groupBy("c").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "also")).alias("x")).select("x.id", "x.also")
    keep = first.unionByName(rows.where("c is null").select("id", "also")).select(named(F.col("id"), F.col("also")))
    return docs.withColumn(kept, named(F.col(key), hashed)).join(keep, kept, "left_semi").dropDuplicates([kept]).drop(kept)
