"""The keyed store: merges by every mode, nothing rewritten twice, and the old state after every failure."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources.store import Conflict, Store

SCHEMA = "k int, s string, v double, note string"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store", buckets=4)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(store):
    root = store.path.removeprefix("file://")
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names}


def test_modes_against_plain_dictionaries(spark, store):
    import random

    rng, held = random.Random(2), {}
    make = lambda n: {(rng.choice([*range(30), None]), rng.choice(["a", "b", None])): (rng.choice([None, 1.0, 2.0]), rng.choice([None, "x"])) for _ in range(n)}
    for turn in range(7):
        mode, new = ["full", "full", "subset", "ignore", "full", "subset", "ignore"][turn], make(15)
        df = spark.createDataFrame([(*k, *v) for k, v in new.items()], SCHEMA).repartition(3)
        before, old = dict(held), store.read("t") if held else None
        told = store.upsert("t", df.drop("note") if mode == "subset" else df, keys=["k", "s"], mode=mode)
        for k, v in new.items():
            if mode == "full" or k not in held:
                held[k] = v if mode != "subset" else (v[0], None)
            elif mode == "subset":
                held[k] = (v[0], held[k][1])
        assert rows(store.read("t")) == sorted(((*k, *v) for k, v in held.items()), key=repr)
        assert told["added"] == len(held.keys() - before.keys()) and told["changed"] == sum(before[k] != held[k] for k in before)
        if old is not None:  # a reader that began before still sees the version before
            assert rows(old) == sorted(((*k, *v) for k, v in before.items()), key=repr)


def test_a_second_run_writes_nothing(spark, store):
    df = spark.createDataFrame([(i, "a", float(i), None) for i in range(40)], SCHEMA)
    first = store.upsert("t", df, keys=["k"], stamp="updated_at")
    held, stamps = files(store), rows(store.read("t"))
    again = store.upsert("t", df, keys=["k"], stamp="updated_at")
    assert (first["added"], first["buckets"], again) == (40, 4, {"version": first["version"], "added": 0, "changed": 0, "buckets": 0})
    assert files(store) == held and rows(store.read("t")) == stamps


def test_only_buckets_with_changes_are_written(spark, store):
    df = spark.createDataFrame([(i, "a", float(i), None) for i in range(40)], SCHEMA)
    store.upsert("t", df, keys=["k"], stamp="at")
    before = store.manifest()["tables"]["t"]["folders"]
    told = store.upsert("t", df.where("k < 20").withColumn("v", F.when(F.col("k") == 7, -1.0).otherwise(F.col("v"))), keys=["k"], stamp="at")
    after = store.manifest()["tables"]["t"]["folders"]
    assert told["changed"] == 1 and told["buckets"] == 1 and sum(before[b] != after[b] for b in before) == 1
    stamps = {r.at for r in store.read("t").where("k <> 7").collect()}
    assert len(stamps) == 1 and store.read("t").where("k = 7").first().at > stamps.pop()


def test_failures_leave_the_state_before(spark, store):
    good = spark.createDataFrame([(1, "a", 1.0, None)], SCHEMA)
    store.refresh({"raw": (good, ["k"]), "features": (good, ["k"])})
    store.upsert("history", good, keys=["k"])
    state = (store.manifest(), *(rows(store.read(t)) for t in store.tables()))
    bad = spark.range(5).select(F.col("id").cast("int").alias("k"), F.raise_error(F.lit("broken")).cast("string").alias("s"), F.lit(2.0).alias("v"), F.lit("x").alias("note"))
    twice = spark.createDataFrame([(2, "a", 1.0, None), (2, "b", 2.0, None)], SCHEMA)
    new = spark.createDataFrame([(9, "z", 9.0, "n")], SCHEMA)
    for broken in (bad, twice):
        with pytest.raises(Exception, match="broken|unique"):
            store.refresh({"raw": (new, ["k"]), "features": (broken, ["k"])})  # the first of two is written, and not seen
        with pytest.raises(Exception, match="broken|unique"):
            store.upsert("raw", broken, keys=["k"])
        assert (store.manifest(), *(rows(store.read(t)) for t in store.tables())) == state
    version = store.refresh({"raw": (new, ["k"]), "features": (new, ["k"])})
    assert rows(store.read("raw")) == rows(new) and rows(store.read("features")) == rows(new) and rows(store.read("history")) == rows(good)
    assert rows(store.read("raw", version - 1)) == rows(good)
    assert store.clean(keep=1) > 0 and store.versions() == [version]
    assert rows(store.read("raw")) == rows(new) and rows(store.read("history")) == rows(good)
    assert store.clean(keep=1) == 0


def test_two_writers(spark, store, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0, None)], SCHEMA)
    store.upsert("t", df, keys=["k"])
    before = store.manifest()
    other = Store(spark, store.path)
    other.upsert("t", df.withColumn("v", F.lit(2.0)), keys=["k"])
    with pytest.raises(Conflict):
        store._commit(before, before["tables"])
    assert store.read("t").first().v == 2.0 and not [f for f in files(store) if "/_" in f and "manifests" in f and not f.endswith(".crc")]


def test_refusals_and_empty_tables(spark, store):
    df = spark.createDataFrame([(1, "a", 1.0, None)], SCHEMA)
    store.upsert("t", df, keys=["k"])
    for frame, keys, mode, text in ((df.withColumn("more", F.lit(1)), ["k"], "full", "no columns"), (df.drop("v"), ["k"], "full", "missing"), (df, ["s"], "full", "keyed"), (df, ["k"], "other", "mode"), (df, [], "full", "keyed")):
        with pytest.raises(ValueError, match=text):
            store.upsert("t", frame, keys=keys, mode=mode)
    assert store.upsert("t", df.limit(0), keys=["k"])["buckets"] == 0
    store.upsert("empty", df.limit(0), keys=["k"])
    assert store.read("empty").count() == 0 and store.read("empty").columns == df.columns
    store.upsert("empty", df, keys=["k"])
    assert rows(store.read("empty")) == rows(df)
    store.drop("empty")
    assert store.tables() == ["t"]


def test_rows_that_differ_when_computed_again(spark, store, monkeypatch):
    """As averages of doubles do in another order of a shuffle: each upsert takes its rows once, and the query gives both upserts the same ones."""
    import random

    from tidemark.plans import stored as plans

    noise = F.udf(lambda: random.SystemRandom().random(), "double").asNondeterministic()
    new = spark.range(20).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit("a").alias("series_id"), noise().alias("value"))
    monkeypatch.setattr(plans, "_base_new", lambda spark, sf_dir: (new, new))
    assert plans.store_upsert(spark, "").count() == 20
