"""Sharding by balanced label propagation.

Nodes are units: the copies of one text, or a part of them where they are many; parts of one text
start in the same or in consecutive shards and stay there. Units that share a long line are linked through that line and start together. Each round, lines tell their members which shards hold most of them, as many as
their rows fill; a unit asks to move where most of its lines point; every shard accepts the requests of highest gain up to its room, found from a
histogram of gains rather than from a sort in one task. At the end counts are made exactly even: surplus rows of
full shards fill the gaps of others, and at most one unit is cut at each border. DataFrame functions only.

The law is ``rows``: counts of any two shards differ by one at most. Nulls and edge cases: a null text counts no bytes
and equals an empty one; null ids and repeated rows are rows like others; with fewer rows than shards, some shards are
empty; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, rank_in_blocks

LAW = "rows"
OVERHEAD = 16
LINE_CHARS = 40
MAX_UNIT = 10_000
#: Parts of the requests of one gain that a shard takes or refuses whole.
LOTS = 32
#: Texts that are cut at most: the most common ones. Others have at most a share of 1 / MOST_CUT of all rows.
MOST_CUT = 10_000
#: Common lines that are sent to every task at most (16 bytes each).
SENT_LINES = 100_000


def _base(docs: DataFrame) -> DataFrame:
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = F.array_distinct(F.transform(F.filter(F.split(t, "\n"), lambda x: F.length(x) >= LINE_CHARS), lambda x: F.xxhash64(x)))
    return docs.select("doc_id", (F.octet_length(t) + OVERHEAD).cast("long").alias("size"), F.crc32(t.cast("binary")).cast("long").alias("text_crc32"), F.xxhash64(t, F.octet_length(t)).alias("same"), lines.alias("lines"))


def _homes(items: list, families: list, goal: list[int]) -> tuple[dict, dict, list]:
    """Where the large groups start: shards with rows for each item (family, key, rows) and for what else a family has, and the room
    that is left for all others. A group that fits into a shard isn't split while one has room for it, and a larger one fills
    whole shards; what belongs to one family goes on where the family already is."""
    share, free, placed, others, rest = max(goal), list(goal), {}, {}, dict(families)

    def take(n: int, own: list[int]) -> list[tuple[int, int]]:
        got = []
        while n > 0:
            fits = [s for s in own if free[s] >= n] or ([] if n > share else [s for s in range(len(free)) if free[s] >= n])
            s = min(fits, key=lambda s: (free[s], s)) if fits else max([s for s in own if free[s] > 0] or range(len(free)), key=lambda s: (free[s], -s))
            k = min(n, free[s])
            if k <= 0:  # no room anywhere: rounding of the counts only
                got.append((s, n))
                break
            free[s] -= k
            n -= k
            got.append((s, k))
            if s not in own:
                own.append(s)
        return got

    groups: dict = {}
    for family, key, n in items:
        groups.setdefault((family, None) if family in rest else (None, key), []).append((n, key))
        if family in rest:
            rest[family] -= n
    for family in rest:
        groups.setdefault((family, None), [])
    total = {g: sum(n for n, _ in x) + rest.get(g[0], 0) for g, x in groups.items()}
    for g in sorted(groups, key=lambda g: (-total[g], str(g))):
        own: list[int] = []
        for n, key in sorted(groups[g], key=lambda x: (-x[0], x[1])):
            placed[key] = take(n, own)
        if rest.get(g[0], 0) > 0:
            others[g[0]] = take(rest[g[0]], own)
    return placed, others, [(s, max(0, n)) for s, n in enumerate(free)]


def _start(labels: DataFrame, share: int, goal: list[int]) -> DataFrame:
    """Home shards: units that share their most common line, or their text, start together. ``wide`` is the most common of a unit's
    lines that don't fit into one shard; within the units of such a line those that share another one stay together."""
    spark, least = labels.sparkSession, share // 32
    labels = labels.withColumn("item", F.xxhash64(F.coalesce("wide", F.lit(0)), "near"))
    # At most 32 items and 32 families for each shard reach the driver.
    items = [(r["wide"], r["item"], r["n"]) for r in labels.groupBy("wide", "item").agg(F.sum("rows").alias("n")).where(F.col("n") > least).collect()]
    families = [(r["wide"], r["n"]) for r in labels.where("wide is not null").groupBy("wide").agg(F.sum("rows").alias("n")).where(F.col("n") > least).collect()]
    placed, others, free = _homes(items, families, goal)

    def frame(found: dict, key: str, out: str) -> DataFrame:
        rows = [(k, [s for s, _ in x], [float(sum(n for _, n in x[: i + 1])) / sum(n for _, n in x) for i in range(len(x))]) for k, x in found.items()]
        return F.broadcast(spark.createDataFrame(rows, f"{key} long, {out}_s array<int>, {out}_e array<double>"))

    part = lambda *x: F.pmod(F.xxhash64(*x), F.lit(1_000_000)) / 1_000_000
    at = lambda ends, x: F.size(F.filter(ends, lambda e: e <= x))
    labels = labels.join(frame(placed, "item", "i"), "item", "left").join(frame(others, "wide", "f"), "wide", "left")
    room = sum(n for _, n in free)
    ends = F.array(*(F.lit(sum(n for _, n in free[: s + 1]) / room if room else (s + 1) / len(free)) for s in range(len(free))))
    own = F.coalesce((F.col("piece") + 0.5) / F.col("pieces"), part("unit"))
    shard = F.coalesce(F.get("i_s", at(F.col("i_e"), own)), F.get("f_s", at(F.col("f_e"), part("near"))), at(ends, part(F.coalesce("wide", "near"))))
    return labels.select("unit", "rows", "fixed", "linked", F.least(shard, F.lit(len(goal) - 1)).cast("int").alias("shard"))


def _moves(links: DataFrame, labels: DataFrame, share: int, room: list[int], step: int) -> DataFrame:
    """Accepted moves (unit, to): every shard takes the requests of highest gain as long as all of a gain and lot fit into its room."""
    at = links.join(labels.select("unit", "rows", "fixed", "shard"), "unit")
    votes = at.groupBy("line", "shard").agg(F.sum("rows").alias("n"), F.max("spread").alias("spread"))
    # A line asks for as many shards as its rows fill, those that hold most of it; one row for each shard at most.
    best = votes.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("n", (-F.col("shard")).alias("s"))), asc=False).alias("b"), F.ceil(F.sum("n") / share).cast("int").alias("k"), F.max("spread").alias("spread"))
    best = best.select("line", F.transform(F.slice("b", 1, F.col("k")), lambda x: -x["s"]).alias("wanted"), F.explode(F.sequence(F.lit(0), F.col("spread") - 1)).alias("salt"))
    to = F.when(F.array_contains("wanted", F.col("shard")), F.col("shard")).otherwise(F.get("wanted", F.pmod(F.col("shard") + step, F.size("wanted"))))
    # A line counts less the more units hold it; its own unit's vote for the present shard is part of it.
    asks = at.where(~F.col("fixed")).join(best, ["line", "salt"]).withColumn("to", to).groupBy("unit", "shard", "rows", "to").agg(F.sum(1 / F.col("units")).alias("weight"))
    mine = F.when(F.col("to") == F.col("shard"), F.col("weight")).otherwise(0.0)
    asks = asks.groupBy("unit", "shard", "rows").agg(F.max(F.struct("weight", "to")).alias("b"), F.sum(mine).alias("own"))
    asks = asks.select("unit", "rows", F.col("shard").alias("from"), F.col("b.to").alias("to"), (F.col("b.weight") - F.col("own")).alias("gain"))
    asks = asks.where((F.col("gain") > 0) & ((F.col("to") > F.col("from")) if step % 2 else (F.col("to") < F.col("from"))))
    asks = cut(asks.withColumn("grade", F.greatest(F.lit(-20), F.least(F.lit(20), F.floor(F.log2("gain")).cast("int")))))
    asks = asks.withColumn("lot", F.pmod(F.xxhash64("unit", F.lit(step)), F.lit(LOTS)).cast("int"))
    grades = asks.groupBy("to", "grade", "lot").agg(F.sum("rows").alias("n"))  # at most 41 * LOTS for each shard
    w = Window.partitionBy("to").orderBy(F.desc("grade"), "lot").rowsBetween(Window.unboundedPreceding, 0)
    free = F.get(F.array(*(F.lit(int(r)) for r in room)), F.col("to"))
    taken = grades.withColumn("sum", F.sum("n").over(w)).where(F.col("sum") <= free).select("to", "grade", "lot")
    return asks.join(F.broadcast(taken), ["to", "grade", "lot"]).select("unit", "to")


def shard_documents(docs: DataFrame, *, shards: int = 40, rounds: int = 4, slack: float = 0.1) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) for every row of ``docs`` (doc_id, text)."""
    base = cut(_base(docs))
    total = base.count()
    share = max(1, -(-total // shards))
    goal = [total // shards + (s < total % shards) for s in range(shards)]
    most = max(1, min(share // 8, MAX_UNIT))
    many = base.groupBy("same").agg(F.count("*").alias("n")).where(F.col("n") > most).orderBy(F.desc("n"), "same").limit(MOST_CUT).select("same", F.ceil(F.col("n") / most).cast("int").alias("pieces"))
    base = base.join(F.broadcast(many), "same", "left")
    piece = F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("pieces")))
    base = cut(base.select("doc_id", "size", "text_crc32", "same", piece.alias("piece"), "pieces", F.xxhash64("same", piece).alias("unit"), "lines"))
    held = base.select("unit", F.explode("lines").alias("line")).groupBy("unit", "line").agg(F.count("*").alias("held"))
    useful = cut(held.groupBy("line").agg(F.count("*").alias("units"), F.sum("held").alias("n")).where(F.col("units") > 1))
    # The members of a common line are dealt over several tasks. The most common lines are sent to every task; each of the others has at most a share of 1 / SENT_LINES of all rows of ``held``.
    common = cut(useful.where(F.col("units") > most).select("line", "units", F.ceil(F.col("units") / most).cast("int").alias("spread")))
    more = common.limit(SENT_LINES + 1).count() > SENT_LINES
    sent = common.orderBy(F.desc("units"), "line").limit(SENT_LINES) if more else common
    useful = useful.join(common.select("line", "spread"), "line", "left").withColumn("spread", F.coalesce("spread", F.lit(1)))
    rows = held.drop("held").join(F.broadcast(sent.select("line", "spread")), "line", "left")
    if more:
        rest = rows.where("spread is null").drop("spread").join(common.select("line", "spread"), "line", "left")
        rows = rows.where("spread is not null").unionByName(rest)
    links = rows.select("unit", "line", F.coalesce(F.pmod(F.xxhash64("unit"), F.col("spread")), F.lit(0)).cast("int").alias("salt"))
    links = cut(links.join(useful.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread") - 1))), ["line", "salt"]))
    lead = lambda c: F.max(F.when(c, F.struct("n", "line")))
    leaders = links.groupBy("unit").agg(lead(F.col("n") > share).alias("wide"), lead(F.col("n") <= share).alias("near"))
    labels = base.groupBy("unit").agg(F.count("*").alias("rows"), F.max("same").alias("same"), F.max("piece").alias("piece"), F.max("pieces").alias("pieces")).join(leaders, "unit", "left")
    labels = labels.select("unit", "rows", "piece", "pieces", F.col("pieces").isNotNull().alias("fixed"), (F.col("wide").isNotNull() | F.col("near").isNotNull() | (F.col("rows") > 1)).alias("linked"), F.col("wide.line").alias("wide"), F.coalesce("near.line", "same").alias("near"))
    labels = cut(_start(cut(labels), share, goal))
    links = links.select("unit", "line", "units", "salt", "spread")
    for step in range(rounds):
        load = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.sum("rows").alias("n")).collect()}  # one row for each shard
        room = [max(0, int(share * (1 + slack)) - load.get(s, 0)) for s in range(shards)]
        moves = _moves(links, labels, share, room, step)
        labels = cut(labels.join(moves, "unit", "left").select("unit", "rows", "fixed", "linked", F.coalesce("to", "shard").alias("shard")))
    # Within a shard, parts of large texts come first and units without links last: these are what fills the gaps of others.
    tier = F.when(F.col("fixed"), 0).when(F.col("linked"), 1).otherwise(2)
    labels = labels.select("unit", "rows", "shard", (F.col("shard") * 3 + tier).alias("place"))
    tiers = {r["place"]: r["n"] for r in labels.groupBy("place").agg(F.sum("rows").alias("n")).collect()}  # three rows for each shard
    load = {s: sum(tiers.get(3 * s + i, 0) for i in range(3)) for s in range(shards)}
    before = [sum(tiers.get(3 * s + j, 0) for j in range(i)) for s in range(shards) for i in range(3)]
    over, gap = [0], [0]
    for s in range(shards):
        over.append(over[-1] + max(0, load.get(s, 0) - goal[s]))
        gap.append(gap[-1] + max(0, goal[s] - load.get(s, 0)))
    longs = lambda xs: F.array(*(F.lit(int(x)).cast("long") for x in xs))
    placed = base.select("doc_id", "size", "text_crc32", "unit").join(labels.select("unit", "shard", "place"), "unit")
    placed = rank_in_blocks(placed, "place", F.xxhash64("unit"), ["unit", "doc_id", "text_crc32"], "at")
    placed = placed.withColumn("at", F.col("at") + F.get(longs(before), F.col("place")))
    stays = F.col("at") < F.get(longs(goal), F.col("shard"))
    placed = placed.withColumn("spare", F.when(~stays, F.get(longs(over), F.col("shard")) + F.col("at") - F.get(longs(goal), F.col("shard"))))
    placed = placed.withColumn("new", F.when(~stays, F.size(F.filter(longs(gap[1:]), lambda x: x <= F.col("spare")))))
    filled = F.get(longs([load.get(s, 0) for s in range(shards)]), F.col("new")) + F.col("spare") - F.get(longs(gap[:-1]), F.col("new"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.coalesce("new", "shard").cast("int").alias("shard"),
        F.coalesce(filled, F.col("at")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
