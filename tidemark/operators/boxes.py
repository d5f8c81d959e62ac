"""Sums over earlier points within a box around each row, for series of any length.

Points of a series are numbered by time and dealt into blocks. A query row looks at all blocks before its bound in time, the last one up to a place in it. Within a block, a prefix in time falls into
runs of lengths that are powers of two, and a run keeps its points in a merge-sort tree: ordered by the first coordinate, each node of the tree has its points by the second one with running
sums. A box is a few nodes, and a node two binary searches, so a row costs the logarithm of a block squared and not the points in its box. A task holds one block of points and one of queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chunks import numbered
from ..functions.storage import stored
from .long_series import asof
from .quantiles import any_large

#: Points of one block, and of the shortest run that has a tree; points of a shorter rest are compared one by one.
BLOCK, RUN = 1 << 16, 1 << 8
_COMPARED = 1 << 22


def tree_sums(x: np.ndarray, y: np.ndarray, values: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """The sums of ``values`` (points by measures) over each box (x from, x to, y from, y to; all included)."""
    by = np.argsort(x, kind="stable")
    x, y, values = x[by], y[by], values[by]
    lo, hi = np.searchsorted(x, boxes[:, 0]), np.searchsorted(x, boxes[:, 1], "right")
    levels = np.sort(y)
    rank = np.searchsorted(levels, y)
    low, high = np.searchsorted(levels, boxes[:, 2]), np.searchsorted(levels, boxes[:, 3], "right")
    out, n, size, place = np.zeros((len(boxes), values.shape[1])), len(x), 1, np.arange(len(x))
    lo, hi = lo.copy(), np.maximum(lo, hi)

    def take(nodes: np.ndarray, rows: np.ndarray) -> None:
        """Add what ``nodes`` of this level hold between the rows' bounds of y."""
        a, b = np.searchsorted(key, nodes * (n + 1) + low[rows]), np.searchsorted(key, nodes * (n + 1) + high[rows])
        out[rows] += running[np.maximum(a, b)] - running[a]

    while True:
        live = lo < hi
        if not live.any():
            return out
        key = place // size * (n + 1) + rank
        order = np.argsort(key, kind="stable")
        key, running = key[order], np.vstack([np.zeros(values.shape[1]), np.cumsum(values[order], 0)])
        left, right = np.flatnonzero(live & (lo % 2 == 1)), np.flatnonzero(live & (hi % 2 == 1))
        take(lo[left], left)
        lo[left] += 1
        right = right[hi[right] > lo[right]] if len(left) else right
        take(hi[right] - 1, right)
        hi[right] -= 1
        lo, hi, size = lo // 2, np.maximum(lo // 2, hi // 2), 2 * size


def plain_sums(x: np.ndarray, y: np.ndarray, values: np.ndarray, boxes: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same over points ``first`` to ``end`` of each box, fewer than RUN, one by one."""
    out = np.zeros((len(boxes), values.shape[1]))
    step = max(1, _COMPARED // RUN)
    for a in range(0, len(boxes), step):
        b, at = boxes[a : a + step], first[a : a + step, None] + np.arange(RUN)
        seen = at < end[a : a + step, None]
        at = np.minimum(at, len(x) - 1)
        seen &= (x[at] >= b[:, :1]) & (x[at] <= b[:, 1:2]) & (y[at] >= b[:, 2:3]) & (y[at] <= b[:, 3:])
        row, col = np.nonzero(seen)
        np.add.at(out, a + row, values[at[row, col]])
    return out


def prefix_sums(x: np.ndarray, y: np.ndarray, values: np.ndarray, boxes: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """The sums over each box of the first ``upto`` points, which are in the order of time."""
    rest = upto // RUN * RUN
    out, size = plain_sums(x, y, values, boxes, rest, upto), RUN
    while size <= len(x):
        has = np.flatnonzero(rest // size % 2 == 1)
        starts = rest[has] // (2 * size) * (2 * size)
        for s in np.unique(starts):
            rows = has[starts == s]
            out[rows] += tree_sums(x[s : s + size], y[s : s + size], values[s : s + size], boxes[rows])
        size *= 2
    return out


def earlier_in_box(df: DataFrame, *, keys: list[str], time: str, until: Column, at: tuple[str, str], reach: tuple[float, float], measures: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """(keys, time, measures...): for each row, the sum of each measure over the rows of its series up to time ``until`` whose coordinates ``at`` both differ from its own by ``reach`` at most. Rows
    without both coordinates or a time neither count nor are asked for; a null measure adds nothing. Times of a series must differ."""
    x, y = at
    points = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(time).isNotNull()).select(*keys, F.col(time).alias("_time"), until.alias("_until"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), *(F.coalesce(e.cast("double"), F.lit(0.0)).alias(f"_m{i}") for i, e in enumerate(measures.values())))
    names = [f"_m{i}" for i in range(len(measures))]
    box = lambda qx, qy: np.column_stack([qx - reach[0], qx + reach[0], qy - reach[1], qy + reach[1]])
    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), f"_time {df.schema[time].dataType.simpleString()}", *(f"{n} double" for n in names)])
    shown = lambda found: found.select(*keys, F.col("_time").alias(time), *(F.col(n).alias(m) for n, m in zip(names, measures, strict=True)))

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        p = group.sort_values("_time")
        upto = np.searchsorted(p["_time"].to_numpy(), p["_until"].to_numpy(), "right")
        x, y = p["_x"].to_numpy(), p["_y"].to_numpy()
        sums = prefix_sums(x, y, p[names].to_numpy(np.float64).reshape(len(p), len(names)), box(x, y), upto)
        out = p[[*keys, "_time"]].reset_index(drop=True)
        for i, n in enumerate(names):
            out[n] = sums[:, i]
        return out[upto > 0]

    if not any_large(df, keys, block):  # each series is one block
        return shown(points.groupBy(*keys).applyInPandas(whole, schema))
    points = stored(numbered(points, keys=keys, time="_time", rows=max(block, 1_000)))
    known = points.select(*keys, F.col("_time").alias("_since"), (F.col("_no") + 1).alias("_upto"))
    asked = asof(points.select(*keys, "_time", "_until", "_x", "_y", "_no"), known, keys=keys, left_time="_until", right_time="_since", cols=["_upto"], strict=False).where("_upto is not null")
    part = lambda c: F.floor(F.col(c) / block)
    last = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_upto") - 1) / block))
    asked = asked.select(*keys, F.explode(last).alias("_b"), part("_no").alias("_q"), "_time", "_x", "_y", F.col("_no").alias("_at"), "_upto").withColumn("_upto", F.least(F.col("_upto") - F.col("_b") * block, F.lit(block)))
    asked = stored(asked)
    # A block goes to the blocks of queries that look at it.
    pairs = asked.groupBy(*keys, "_b", "_q").agg(F.lit(1).alias("_1")).select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_b").alias("_k_b"), F.col("_q"))
    same = part("_no") == F.col("_k_b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    held = points.join(pairs, same).select(*keys, F.col("_k_b").alias("_b"), "_q", F.lit(None).cast(df.schema[time].dataType).alias("_time"), "_x", "_y", F.col("_no").alias("_at"), F.lit(None).cast("long").alias("_upto"), *names)
    both = held.unionByName(asked, allowMissingColumns=True)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        is_query = group["_upto"].notna().to_numpy()
        p, q = group[~is_query].sort_values("_at"), group[is_query]
        boxes = box(q["_x"].to_numpy(), q["_y"].to_numpy())
        sums = prefix_sums(p["_x"].to_numpy(), p["_y"].to_numpy(), p[names].to_numpy(np.float64).reshape(len(p), len(names)), boxes, q["_upto"].to_numpy(np.int64))
        out = q[[*keys, "_time"]].reset_index(drop=True)
        for i, n in enumerate(names):
            out[n] = sums[:, i]
        return out

    return shown(both.groupBy(*keys, "_b", "_q").applyInPandas(run, schema).groupBy(*keys, "_time").agg(*(F.sum(n).alias(n) for n in names)))
