"""Helpers shared by the corpus operators: reading, lineage cuts, words, shingles."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words, in Java and Python syntax alike: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE = 5
#: Rows and bytes of text in one Arrow batch; texts may be very long, so batches are small.
BATCH_ROWS, BATCH_BYTES = 400, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One input table, cut to ``cols`` so that the scan reads nothing else."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Bound the memory of a Python worker by rows and bytes, since texts may be long. The session keeps the bounds: plans read them when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it. Where it names none, a temporary one of this machine if driver
    and executors are one process (tests), else an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isDefined():
            return jsc.getCheckpointDir().get()
        if not jsc.isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Like :func:`cut`, as columnar files in the shared folder, whose path is added to ``paths``. Plans that read them know their true size. A
    checkpoint keeps the estimate of the plan it was computed by instead, and that of a join is the product of its sides: where each round of a loop joins what
    the round before left, its digits double, and after some ten rounds planning takes longer than all work. Loops take this one."""
    path = f"{shared_dir(df.sparkSession)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written for a later step, in whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def private(*frames: DataFrame) -> str:
    """A prefix that no column of the frames starts with."""
    return "_" * (1 + max([len(c) - len(c.lstrip("_")) for df in frames for c in df.columns], default=0))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, rows: int, counts: str | None = None, most: int = 10_000) -> DataFrame:
    """(key, _salts): the keys of more than ``rows`` rows, the ``most`` largest of them, so that it may be broadcast, with the number of tasks to
    deal each over. Keys beyond those have at most a share of 1 / ``most`` of all rows. ``counts`` names a column with a key's rows."""
    n = df.groupBy(key).agg(F.count("*").alias("_n")) if counts is None else df.select(key, F.col(counts).alias("_n"))
    return n.where(F.col("_n") > rows).orderBy(F.desc("_n")).limit(most).select(key, F.ceil(F.col("_n") / rows).cast("int").alias("_salts"))


def spread(df: DataFrame, key: str, hot: DataFrame, *by) -> DataFrame:
    """``df`` with ``_salt``, by which rows of a hot key are dealt over several tasks; 0 for other keys."""
    salt = F.pmod(F.xxhash64(*by), F.coalesce("_salts", F.lit(1))).cast("int")
    return df.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")


def copied(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``df`` with a row for each ``_salt`` of its key, to be joined with what was :func:`spread`."""
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return df.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(salts)).drop("_salts")


def rank_in_blocks(df: DataFrame, group: str, salt, order: list, out: str, rows_per_block: int = 20_000, most_groups: int = 4096) -> DataFrame:
    """Exact 0-based rank of each row within ``group``, of which there are few, without one task per group.

    Rows of a group are dealt to blocks by the integer column ``salt`` (a hash); the rank is the number of rows
    in the group's earlier blocks plus the position in the own block, by ``order``. A block that is far too large because many rows have one salt is only slow. The groups'
    counts, at most ``most_groups``, reach the driver; block counts, whose number is rows / ``rows_per_block`` plus one for each group, are summed over a whole group.
    """
    n = df.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") > rows_per_block).limit(most_groups + 1).collect()
    if len(n) > most_groups:
        raise ValueError(f"more than {most_groups} large groups")
    blocks = df.sparkSession.createDataFrame([(r[group], -(-r["n"] // rows_per_block)) for r in n], f"{group} {df.schema[group].dataType.simpleString()}, _blocks long")
    df = df.join(F.broadcast(blocks), group, "left").withColumn("_block", F.pmod(salt, F.coalesce("_blocks", F.lit(1)))).drop("_blocks")
    counts = df.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "_block", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    own = Window.partitionBy(group, "_block").orderBy(*order)
    return (
        df.withColumn("_at", F.row_number().over(own) - 1)
        .join(counts, [group, "_block"])
        .withColumn(out, (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_block", "_at", "_before")
    )


_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = x.copy()
    x ^= x >> np.uint64(33)
    x *= _A
    x ^= x >> np.uint64(33)
    x *= _B
    x ^= x >> np.uint64(33)
    return x


class WordHasher:
    """64-bit hashes of words, kept for words seen before, up to a bound."""

    def __init__(self, most: int = 250_000):
        import xxhash

        self._hash, self._most, self._seen = xxhash.xxh3_64_intdigest, most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        seen = self._seen
        try:
            return np.fromiter(map(seen.__getitem__, words), dtype=np.uint64, count=len(words))
        except KeyError:
            if len(seen) > self._most:
                seen.clear()
            h = self._hash
            for w in words:
                if w not in seen:
                    seen[w] = h(w)
            return np.fromiter(map(seen.__getitem__, words), dtype=np.uint64, count=len(words))


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: bytes.split() without arguments splits at exactly these: \x20 \x09-\x0D.


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_hashes(words: list[list[bytes]], hasher: WordHasher, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word ``k``-gram of each text, in order, and offsets; a shorter text has its
    whole sequence as one; none without words. Repeats within a text are kept."""
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    h = hasher([w for x in words for w in x])
    start = np.cumsum(n) - n
    x = np.zeros(max(0, len(h) - k + 1), dtype=np.uint64)
    for j in range(k):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(x)])
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    offsets = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(offsets[-1], dtype=np.uint64)
    for i in range(len(words)):
        if n[i] >= k:
            out[offsets[i] : offsets[i + 1]] = x[start[i] : start[i] + count[i]]
        elif n[i]:
            y = np.full(1, np.uint64(n[i]))
            for v in h[start[i] : start[i] + n[i]]:
                y = mix(y * np.uint64(0x9E3779B97F4A7C15) + v)
            out[offsets[i]] = y[0]
    return out, offsets


def distinct_sets(words: list[list[bytes]], hasher: WordHasher) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, at = shingle_hashes(words, hasher)
    return [np.unique(h[at[i] : at[i + 1]]) for i in range(len(words))]
