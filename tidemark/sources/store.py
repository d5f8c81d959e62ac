"""A store of keyed tables on a shared file system, with upserts and refreshes that happen whole or not at all.

A table's rows lie in buckets by the hash of their key, each a folder of Parquet files. A manifest lists the folders of all tables; manifests are numbered, and the last one is the
store's state. A change writes new folders beside the old ones and then one manifest under the next number: a file that is renamed into place, which fails if another writer was first. So
readers see the state before or after, a run that fails leaves the state before, and several tables change at once.

An upsert reads only the buckets that its keys fall into, and writes only those in which a row changes; running it again writes nothing. Renaming must be
atomic, as on HDFS and local file systems.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.storage import stored


class Conflict(RuntimeError):
    """Another writer has changed the store meanwhile."""


class Store:
    """The tables under ``path``. ``buckets``: how many a new table gets; a bucket should fit a task."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._files = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._fs.Path("/".join([self.path, *parts]))

    def versions(self) -> list[int]:
        """The numbers of all manifests."""
        folder = self._path("manifests")
        names = [x.getPath().getName() for x in self._files.listStatus(folder)] if self._files.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        version = version if version is not None else known[-1] if known else 0
        if not version:
            return {"version": 0, "tables": {}}
        stream = self._files.open(self._path("manifests", f"{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, before: dict, tables: dict) -> int:
        version = before["version"] + 1
        made = self._path("manifests", f"_{uuid.uuid4().hex}")
        stream = self._files.create(made)
        stream.write(bytearray(json.dumps({"version": version, "tables": tables}).encode()))
        stream.close()
        target = self._path("manifests", f"{version:012d}.json")
        if self._files.exists(target) or not self._files.rename(made, target):
            self._files.delete(made, False)
            raise Conflict(f"version {version} is there already")
        return version

    def tables(self) -> list[str]:
        return sorted(self.manifest()["tables"])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table's rows, of the last or an earlier version."""
        return self._rows(self.manifest(version)["tables"][name])

    def _rows(self, table: dict, only: set[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(table["schema"])
        paths = [f"{self.path}/{p}" for b, p in table["folders"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self, keys: list[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _write(self, df: DataFrame, name: str) -> dict[str, str]:
        """``df`` with a column _bucket, as one folder for each; their places by bucket."""
        folder = f"data/{name}-{uuid.uuid4().hex}"
        df.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        made = [x.getPath().getName() for x in self._files.listStatus(self._path(folder))]
        return {n.removeprefix("_bucket="): f"{folder}/{n}" for n in made if n.startswith("_bucket=")}

    def _new(self, df: DataFrame, keys: list[str]) -> dict:
        _unique(df, keys)
        return {"keys": keys, "buckets": self.buckets, "schema": df.schema.jsonValue(), "folders": {}}

    def upsert(self, name: str, new: DataFrame, *, keys: list[str], mode: str = "full", stamp: str | None = None) -> dict:
        """Merge ``new`` by key, which must be unique in it; null keys are equal. ``full``: all columns of a known key are overwritten. ``subset``: only the columns that ``new`` has are, also by nulls. ``ignore``: known keys stay as
        they are. ``stamp`` names a column that gets the time of the change in rows that were added or changed, and in no others. Returns the version, and how many rows were added and changed and buckets written."""
        before = self.manifest()
        if mode not in ("full", "subset", "ignore"):
            raise ValueError(f"unknown mode {mode}")
        new = new.withColumn(stamp, F.current_timestamp()) if stamp else new
        new = stored(new)  # once: a sum of doubles may come out otherwise when it is computed again
        known = before["tables"].get(name)
        if known is None:
            known = self._new(new, keys)
        elif known["keys"] != keys:
            raise ValueError(f"{name} is keyed by {known['keys']}")
        else:
            _unique(new, keys)
        schema = StructType.fromJson(known["schema"])
        if extra := set(new.columns) - set(schema.names):
            raise ValueError(f"{name} has no columns {sorted(extra)}")
        if mode == "full" and (lacking := set(schema.names) - set(new.columns)):
            raise ValueError(f"columns {sorted(lacking)} are missing; mode subset leaves them")
        given = [c for c in schema.names if c in new.columns and c not in keys]
        new = stored(new.select(self._bucket(keys, known["buckets"]).alias("_bucket"), *(F.col(k).cast(schema[k].dataType).alias(k) for k in keys), F.lit(True).alias("_there"), *(F.col(c).cast(schema[c].dataType).alias(f"_new_{c}") for c in given)))
        touched = {r[0] for r in new.select("_bucket").distinct().collect()}  # at most the number of buckets
        base = self._rows(known, touched).withColumns({"_bucket": self._bucket(keys, known["buckets"]), "_old": F.lit(True)})
        named = new.select(*(F.col(k).alias(f"_key_{k}") for k in keys), F.col("_bucket").alias("_new_bucket"), "_there", *(f"_new_{c}" for c in given))
        same = reduce(lambda a, k: a & F.col(k).eqNullSafe(F.col(f"_key_{k}")), keys, F.col("_bucket") == F.col("_new_bucket"))
        both = base.join(named, same, "full_outer")
        added, found = F.col("_old").isNull(), F.col("_old") & F.col("_there")
        differs = reduce(lambda a, c: a | ~F.col(c).eqNullSafe(F.col(f"_new_{c}")), [c for c in given if c != stamp], F.lit(False))
        change = F.coalesce(added | (found & differs & F.lit(mode != "ignore")), F.lit(False))
        out = {k: F.when(added, F.col(f"_key_{k}")).otherwise(F.col(k)).alias(k) for k in keys}
        out |= {c: (F.when(F.col("_change"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in given else F.col(c)).alias(c) for c in schema.names if c not in keys}
        merged = both.withColumn("_change", change).select(F.coalesce("_bucket", "_new_bucket").alias("_bucket"), "_change", added.alias("_added"), *(out[c] for c in schema.names))
        merged = stored(merged)
        counts = merged.where("_change").groupBy("_bucket").agg(F.count_if("_added").alias("added"), F.count_if(~F.col("_added")).alias("changed")).collect()  # at most the number of buckets
        told = {"added": sum(r["added"] for r in counts), "changed": sum(r["changed"] for r in counts), "buckets": len(counts)}
        if not counts and name in before["tables"]:
            return {"version": before["version"], **told}
        which = self.spark.createDataFrame([(r["_bucket"],) for r in counts], "_bucket int")
        folders = self._write(merged.join(F.broadcast(which), "_bucket", "left_semi").drop("_change", "_added"), name) if counts else {}
        tables = before["tables"] | {name: known | {"folders": known["folders"] | folders}}
        return {"version": self._commit(before, tables), **told}

    def refresh(self, tables: dict[str, tuple[DataFrame, list[str]]]) -> int:
        """Replace whole tables, each given as (rows, keys), all at once. Tables that aren't named, such as the history of results, stay. Nothing changes if one of them fails."""
        before, made = self.manifest(), {}
        for name, (df, keys) in tables.items():
            df = stored(df)
            made[name] = self._new(df, keys)
            made[name]["folders"] = self._write(df.withColumn("_bucket", self._bucket(keys, self.buckets)), name)
        return self._commit(before, before["tables"] | made)

    def drop(self, *names: str) -> int:
        before = self.manifest()
        return self._commit(before, {k: v for k, v in before["tables"].items() if k not in names})

    def clean(self, keep: int = 1) -> int:
        """Delete what only versions before the last ``keep`` refer to, and what failed runs left. Don't run it beside a writer. Returns how many folders went."""
        known = self.versions()
        kept = known[-keep:]
        used = {p for v in kept for t in self.manifest(v)["tables"].values() for p in t["folders"].values()}
        gone = 0
        for v in known[: len(known) - len(kept)]:
            self._files.delete(self._path("manifests", f"{v:012d}.json"), False)
        folder = self._path("data")
        for top in self._files.listStatus(folder) if self._files.exists(folder) else []:
            parts = [x.getPath() for x in self._files.listStatus(top.getPath()) if x.isDirectory()]
            free = [p for p in parts if f"data/{top.getPath().getName()}/{p.getName()}" not in used]
            gone += len(free)
            for p in free if len(free) < len(parts) else [top.getPath()]:
                self._files.delete(p, True)
        return gone


def _unique(df: DataFrame, keys: list[str]) -> None:
    if not keys:
        raise ValueError("a table needs a key")
    if df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count():
        raise ValueError(f"keys {keys} are not unique")
