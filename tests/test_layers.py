"""Layered tables: lookups against sets, merges, commits, replays, and what a lookup reads."""

import os
import random

import pytest
from pyspark.sql import functions as F

from paystrata.session import scratch
from paystrata.sources import layers
from paystrata.sources.layers import Layers

SCHEMAS = {"t": "k string, v bigint", "d": "name string"}


def store(spark, path, **more):
    return Layers(spark, str(path / "s"), SCHEMAS, {"t": "k"}, **more)


def frame(spark, keys):
    return spark.createDataFrame([(k, 0) for k in keys], SCHEMAS["t"])


def add(spark, s, epoch, keys, names=()):
    """First write wins, as the flush does it; returns the keys that were new."""
    runs = s.runs(epoch)
    with scratch(spark) as keep:
        new = keep(s.absent("t", frame(spark, keys), runs, keep), "new")
        s.commit(epoch, {"t": new, "d": spark.createDataFrame([(n,) for n in names], SCHEMAS["d"])})
        return sorted((r.k for r in new.collect()), key=str)


def test_lookup_is_exact_over_merges(spark, tmp_path):
    rng, seen = random.Random(5), set()
    s = store(spark, tmp_path, fanout=3, slice_keys=16)
    for epoch in range(8):
        keys = {f"k{rng.randint(0, 200)}" for _ in range(25)}
        assert add(spark, s, epoch, keys, [f"n{epoch}"]) == sorted(keys - seen)
        seen |= keys
    assert sorted(r.k for r in s.read("t").collect()) == sorted(seen)
    assert sorted(r.name for r in s.read("d").collect()) == [f"n{e}" for e in range(8)]
    levels = sorted(r.level for r in s.runs() if r.table == "t")
    assert levels == [0, 0, 1, 1]
    # What was merged is gone one epoch later, and so are the manifests nobody starts from.
    assert s.epochs() == [6, 7]
    assert len([n for n in os.listdir(f"{s.root}/t") if n.startswith("batch=")]) == 2


def test_filter_words(spark):
    """A key's bits are in its run's filter; most other keys' are not."""
    place = lambda lo, hi: layers._placed(spark.range(lo, hi).selectExpr("string(id) AS key", "'r' AS run", "188 AS words", "4 AS n"))
    words = place(0, 1000).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    hit = (F.col("bits").bitwiseAND(F.col("mask"))) == F.col("mask")
    assert place(0, 1000).join(words, "word").filter(hit).count() == 1000
    assert place(1000, 11000).join(words, "word").filter(hit).count() < 1200
    assert place(0, 1000).filter("slice < 0 OR slice > 3").count() == 0


def test_replay_and_uncommitted_epoch(spark, tmp_path):
    s = store(spark, tmp_path)
    add(spark, s, 0, ["a", "b"])
    add(spark, s, 1, ["b", "c", None])
    first = sorted(map(str, s.read("t").collect()))
    assert add(spark, s, 1, ["b", "c", None])
    assert sorted(map(str, s.read("t").collect())) == first
    # Rows that were written without a manifest are not there.
    frame(spark, ["z"]).write.parquet(f"{s.root}/t/batch=2")
    assert sorted(map(str, s.read("t").collect())) == first
    assert add(spark, s, 2, ["a", "z"]) == ["z"]


def test_empty_batches_and_long_keys(spark, tmp_path):
    s = store(spark, tmp_path, fanout=2)
    assert add(spark, s, 0, []) == [] and s.read("t").count() == 0
    long = "ü" * 100_000
    assert add(spark, s, 1, ["", long]) == ["", long]
    assert add(spark, s, 2, ["", long, "x"]) == ["x"]


def read_bytes(spark, s, keys, epoch):
    """Bytes of the files that a lookup opens."""
    total = 0
    inner = s._sliced

    def counted(kind, schema, pairs):
        nonlocal total
        for run, n in pairs:
            path = f"{s.root}/{kind}/run={run}/slice={n}"
            total += sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))
        return inner(kind, schema, pairs)
    s._sliced = counted
    try:
        add(spark, s, epoch, keys)
    finally:
        s._sliced = inner
    return total


def test_bytes_read_follow_the_batch_not_the_history(spark, tmp_path):
    """The same batch of six keys beside a history of 1,600 and of 8,000 keys in one run."""
    read = []
    for n in (1600, 8000):
        s = store(spark, tmp_path / str(n), slice_keys=64)
        add(spark, s, 0, [f"x{i}" for i in range(n)])
        read.append(read_bytes(spark, s, ["x1", *[f"b{i}" for i in range(5)]], 1))
    assert read[1] <= 1.6 * read[0]


@pytest.mark.parametrize("hot", [True, False])
def test_hot_keys(spark, tmp_path, hot):
    s = store(spark, tmp_path, slice_keys=100)
    add(spark, s, 0, ["hot"] if hot else ["cold"])
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    with scratch(spark) as keep:
        assert s.absent("t", rows, s.runs(1), keep).count() == (2000 if hot else 3000)
