"""Long series cut into chunks, so that one series runs on many tasks.

Rows are dealt by ranges of (keys, time) and stored with the number of their range. A small table, one row for each series and range, holds
what the ranges before pass on: how many rows there were (so every row gets its number in the series) or the last values seen.

With row numbers, chunks of a fixed length are cut. Windows that reach back ``before`` rows get the last rows of the chunk before once more, as a halo
that is dropped at the end; so any operator on keyed windows works unchanged with the chunk as one more key. No task holds more
than a chunk and its halo of a series, however long it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored_columns

#: Rows of one chunk.
CHUNK_ROWS = 100_000
#: Rows that a task sorts: a range of a long table holds about so many, however short chunks are, so the number of tasks doesn't depend on them.
TASK_ROWS = 500_000
#: Below this many ranges, ranges are as short as chunks.
FEW_RANGES = 64


def parts_of(count: int, rows: int = CHUNK_ROWS) -> int:
    """Into how many ranges or tasks ``count`` rows are dealt: of ``rows`` rows where that makes few, else of up to ``TASK_ROWS``."""
    return max(1, -(-count // max(rows, min(TASK_ROWS, count // FEW_RANGES))))


def ranged(df: DataFrame, *, keys: list[str], time: str | list[str], rows: int = CHUNK_ROWS) -> tuple[DataFrame, int]:
    """``df`` with ``_series`` (its keys in one, so that null keys are equal), ``_range``, the number of its range of (keys, time), and ``_id``, which rises with (keys, time); and how many ranges there are.
    A series' ranges rise with time, and rows of one time share a range. Ranges hold about ``rows`` rows, or more where the table is long (:func:`parts_of`); their borders are sampled, so the rows are stored before anything
    is derived from them."""
    times = [time] if isinstance(time, str) else time
    parts = parts_of(df.count(), rows)
    df = df.repartitionByRange(parts, *keys, *times).sortWithinPartitions(*keys, *times)
    df = stored_columns(df.withColumns({"_range": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}))
    return df.withColumn("_series", F.struct(*keys) if keys else F.lit(1)), parts


def passed_on(df: DataFrame, *, own: dict[str, Column], carry: dict[str, Callable], kept: list[str] | None = None) -> DataFrame:
    """(_series, _range) with what the ranges before pass on: ``own`` aggregates each range, ``carry`` maps a name to a function of the window over all earlier
    ranges of the series; ``kept`` of ``own`` stay. The table has one row for each series and range."""
    w = Window.partitionBy("_series").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    one = df.groupBy("_series", "_range").agg(*(e.alias(n) for n, e in own.items()))
    return one.select("_series", "_range", *(kept or []), *(f(w).alias(n) for n, f in carry.items()))


#: Up to so many rows, what ranges pass on is sent to every task; beyond, it is joined by a shuffle.
SENT_ROWS = 50_000


def with_passed(df: DataFrame, before: DataFrame) -> DataFrame:
    """The rows with what the ranges before theirs pass on."""
    before = stored_columns(before)
    return df.join(F.broadcast(before) if before.count() <= SENT_ROWS else before, ["_series", "_range"])


def numbered(df: DataFrame, *, keys: list[str], time: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with ``_no``, the number of each row in its series, from 0."""
    return _numbered(df, keys=keys, time=time, rows=rows)[0]


def _numbered(df: DataFrame, *, keys: list[str], time: str, rows: int) -> tuple[DataFrame, int]:
    parts, n = ranged(df, keys=keys, time=time, rows=rows)
    before = passed_on(parts, own={"_n": F.count("*"), "_first": F.min("_id")}, carry={"_before": lambda w: F.coalesce(F.sum("_n").over(w), F.lit(0))}, kept=["_first"])
    both = with_passed(parts, before)
    return both.select(*df.columns, (F.col("_id") - F.col("_first") + F.col("_before")).cast("long").alias("_no")), n


def in_chunks(df: DataFrame, op: Callable[..., DataFrame], *, keys: list[str], time: str, before: int = 0, after: int = 0, rows: int = CHUNK_ROWS) -> DataFrame:
    """``op(df, keys=..., time=...)`` with each series cut into chunks of ``rows`` rows. ``before`` and ``after`` are how many rows an output row may depend on, on either
    side; rows of a chunk's halo see less than that and are dropped. Series of one chunk go through ``op`` as they are."""
    if max(before, after) > rows:
        raise ValueError("a chunk must hold as many rows as an operator reaches")
    df, n = _numbered(df, keys=keys, time=time, rows=rows)
    chunk, place = F.floor(F.col("_no") / rows), F.col("_no") % rows
    copies = [F.struct(chunk.alias("chunk"), F.lit(True).alias("own"))]
    if before:
        copies.append(F.when(place >= rows - before, F.struct((chunk + 1).alias("chunk"), F.lit(False).alias("own"))))
    if after:
        copies.append(F.when((place < after) & (chunk > 0), F.struct((chunk - 1).alias("chunk"), F.lit(False).alias("own"))))
    dealt = df.withColumn("_to", F.explode(F.filter(F.array(*copies), lambda x: x.isNotNull()))).drop("_no")
    dealt = dealt.withColumns({"_chunk": F.col("_to.chunk"), "_own": F.col("_to.own")}).drop("_to")
    dealt = dealt.repartition(n, *keys, "_chunk")  # a task's rows don't grow with the table
    return op(dealt, keys=[*keys, "_chunk"], time=time).where("_own").drop("_chunk", "_own")


def running_last(df: DataFrame, *, keys: list[str], time: str | list[str], cols: list[str], rows: int = CHUNK_ROWS, strict: bool = False) -> DataFrame:
    """Each of ``cols`` with its last non-null value up to the row (before its time, if ``strict``), carried from range to range: two levels of scan in place of one long one.
    Values are added as ``_last_<col>``. Rows of one time must be ordered by ``time`` unless strict."""
    times = [time] if isinstance(time, str) else time
    parts, n = ranged(df, keys=keys, time=time if strict else times[0], rows=rows)
    order = Window.partitionBy("_series", "_range").orderBy(*times)
    w = order.rangeBetween(Window.unboundedPreceding, -1) if strict else order.rowsBetween(Window.unboundedPreceding, 0)
    latest = F.struct(*times)
    own = {f"_own{i}": F.max_by(F.col(c), F.when(F.col(c).isNotNull(), latest)) for i, c in enumerate(cols)}
    before = passed_on(parts, own=own, carry={f"_carry{i}": (lambda w, i=i: F.last(f"_own{i}", ignorenulls=True).over(w)) for i in range(len(cols))})
    local = parts.repartition(n, "_series", "_range").withColumns({f"_local{i}": F.last(c, ignorenulls=True).over(w) for i, c in enumerate(cols)})
    return with_passed(local, before).select(*df.columns, *(F.coalesce(f"_local{i}", f"_carry{i}").alias(f"_last_{c}") for i, c in enumerate(cols)))
