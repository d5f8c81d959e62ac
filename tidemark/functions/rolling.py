"""Statistics of the last n rows, in time that grows with the logarithm of n.

Spark's own bounded frames go over the whole frame again for each row. Here a statistic over 1, 2, 4, ... rows is that of the row's half and of the half before it, and one over n rows is put
together from those that n is the sum of. Nothing is subtracted, so no digits are lost, and a value that isn't finite stays in the windows that hold it.

Spark shuffles and sorts the rows by series and time; a task goes through them in batches and keeps only as many rows as windows look back, however long a series is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: (kind, column, n): ``mean``, ``sd`` (of a sample), ``min``, ``max`` or ``ewm``, the exponential average with the weights of span n.
Stat = tuple[str, str, int]
#: Columns of statistics, or a column's name and how a batch gives it.
Step = dict[str, Stat] | tuple[str, Callable[[pa.RecordBatch], pa.Array]]

ROW = "_row_in_series"


def _over(state: tuple, spans: Iterable[int], row: np.ndarray, join: Callable, empty: float = 0.0) -> dict[int, tuple]:
    """The state of the last n rows of the series for each n. ``join(late, early, m)`` puts two together, of which the early one ends m rows before."""
    spans = set(spans)

    def ago(s: tuple, m: int) -> tuple:
        m = min(m, len(row))
        there = row[m:] >= m
        return tuple(np.concatenate([np.full(m, empty), np.where(there, x[: len(x) - m], empty)]) for x in s)

    out: dict[int, tuple] = {}
    covered, width, top = dict.fromkeys(spans, 0), 1, max(spans)
    while True:
        for n in spans:
            if n & width:
                out[n] = join(out[n], ago(state, covered[n]), covered[n]) if n in out else state
                covered[n] += width
        if 2 * width > top:
            return out
        state = join(state, ago(state, width), width)
        width *= 2


def _added(a: tuple, b: tuple, m: int) -> tuple:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def _moments(a: tuple, b: tuple, m: int) -> tuple:
    """Count, mean and sum of squared deviations of both."""
    n = a[0] + b[0]
    share, apart = b[0] / np.maximum(n, 1), b[1] - a[1]
    return n, a[1] + apart * share, a[2] + b[2] + apart * apart * a[0] * share


def _statistics(x: np.ndarray, there: np.ndarray, row: np.ndarray, wanted: dict[str, tuple[str, int]], whole: bool) -> dict[str, pa.Array]:
    """Of one column; ``x`` is 0 where no value is ``there``, ``row`` counts each row's earlier ones in its series."""
    one, of = there.astype("float64"), {}
    for kind, n in wanted.values():
        of.setdefault(kind, set()).add(n)
    held = {n: s[0] for n, s in _over((one,), {n for _, n in wanted.values()}, row, _added).items()}
    made = {}
    if "mean" in of:
        made |= {("mean", n): s / np.maximum(held[n], 1) for n, (s,) in _over((x,), of["mean"], row, _added).items()}
    if "sd" in of:
        made |= {("sd", n): np.sqrt(s / np.maximum(held[n] - 1, 1)) for n, (_, _, s) in _over((one, x, np.where(np.isfinite(x), 0.0, np.nan)), of["sd"], row, _moments).items()}
    nan = np.isnan(x)
    if "max" in of:  # NaN is the largest value
        made |= {("max", n): s for n, (s,) in _over((np.where(there, x, -np.inf),), of["max"], row, lambda a, b, m: (np.maximum(a[0], b[0]),), -np.inf).items()}
    if "min" in of:
        numbers = {n: s[0] for n, s in _over((one * ~nan,), of["min"], row, _added).items()} if nan.any() else held
        low = _over((np.where(there & ~nan, x, np.inf),), of["min"], row, lambda a, b, m: (np.minimum(a[0], b[0]),), np.inf)
        made |= {("min", n): np.where(numbers[n] > 0, s, np.nan) for n, (s,) in low.items()}
    for n in of.get("ewm", ()):
        keep = 1 - 2 / (n + 1)
        s, w = _over((np.where(np.isfinite(x), x, np.nan), one), {n}, row, lambda a, b, m: tuple(p + keep**m * q for p, q in zip(a, b, strict=True)))[n]
        made["ewm", n] = s / np.where(held[n] > 0, w, 1)
    lacking = lambda kind, n: held[n] < (max(n, 2 if kind == "sd" else 1) if whole else 2 if kind == "sd" else 1)
    return {name: pa.array(made[k, n], mask=lacking(k, n)) for name, (k, n) in wanted.items()}


def _step(batches: Iterator[pa.RecordBatch], step: Step, whole: bool) -> Iterator[pa.RecordBatch]:
    if isinstance(step, tuple):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, step[1](b)], names=[*b.schema.names, step[0]])
        return
    reach, last = max(n for _, _, n in step.values()) - 1, None
    cols = list(dict.fromkeys(c for _, c, _ in step.values()))
    for b in batches:
        new = [b.column(ROW).to_numpy()]
        for c in cols:
            x = b.column(c)
            new += [pc.fill_null(x, 0.0).to_numpy(zero_copy_only=False), x.is_valid().to_numpy(zero_copy_only=False)]
        both = new if last is None else [np.concatenate([p, q]) for p, q in zip(last, new, strict=True)]
        with np.errstate(all="ignore"):
            made = {}
            for i, c in enumerate(cols):
                made |= _statistics(both[2 * i + 1], both[2 * i + 2], both[0], {o: (k, n) for o, (k, x, n) in step.items() if x == c}, whole)
        before = len(both[0]) - b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, *(made[o].slice(before) for o in step)], names=[*b.schema.names, *step])
        last = [x[max(0, len(x) - reach) :] for x in both]


def rolled(rows: pa.Table, steps: list[Step], *, row: str, whole: bool = False) -> pa.Table:
    """What :func:`rolling` adds, to the rows of one series in a group's function; they are in order, ``row`` counts each row's earlier ones in its series."""
    batches = iter(rows.append_column(ROW, rows[row]).combine_chunks().to_batches())
    for s in steps:
        batches = _step(batches, s, whole)
    return pa.Table.from_batches(batches).drop_columns(ROW)


def rolling(df: DataFrame, *, keys: list[str], time: str, steps: list[Step], whole: bool = False) -> DataFrame:
    """``df`` with the columns of ``steps``, each of which may use those before it. Nulls count as no values; a window without any gives null, and so does one of fewer than n if ``whole``. The
    columns looked at must be doubles. A batch has ``ROW``, the number of each row's earlier ones in its series."""
    ordered = Window.partitionBy(*keys).orderBy(time)
    df = df.withColumn(ROW, F.row_number().over(ordered).cast("long") - 1).sortWithinPartitions(*keys, time)
    names = [o for s in steps for o in (s if isinstance(s, dict) else [s[0]])]

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        for s in steps:
            batches = _step(batches, s, whole)
        return batches

    return df.mapInArrow(through, StructType([*df.schema.fields, *(StructField(n, DoubleType()) for n in names)])).drop(ROW)
