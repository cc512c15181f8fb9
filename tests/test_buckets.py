"""Bucketed tables: what a write touches, versions, replays, Gold by deltas."""

import os

import pytest
from pyspark.sql import functions as F

from paystrata.operators import gold
from paystrata.plans import batch_etl
from paystrata.sources import tables
from paystrata.sources.buckets import Buckets


def table(spark, tmp_path, n=1000, count=8):
    store = Buckets(spark, str(tmp_path / "t"), ["k"], count)
    store.overwrite(spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("a").alias("w")), 0)
    return store


def rows(df):
    return sorted(map(tuple, df.collect()))


def keys_of(store, version, bucket, n):
    return [r.k for r in store.read(version).filter(store.bucket() == bucket).orderBy("k").limit(n).collect()]


def files(store, version):
    return {d for d in os.listdir(store._data(version)) if d.startswith("bucket=")}


def test_one_per_cent_of_one_bucket_rewrites_one_bucket(spark, tmp_path):
    store = table(spark, tmp_path)
    some = keys_of(store, 0, 3, 10)
    updates = spark.createDataFrame([(k, -k, "b") for k in some], "k bigint, v bigint, w string")
    change = store.upsert(updates, 1)
    assert change.buckets == [3] and files(store, 1) == {"bucket=3"}
    written = {r.bucket: r.written for r in store.manifest(1).filter("bucket >= 0").collect()}
    assert written == {b: int(b == 3) for b in range(8)}
    # Of the version before, the plan reads that bucket alone.
    read = change.went.inputFiles()
    assert all("/v=0/bucket=3/" in f or "/came/" in f for f in read)
    want = {k: (k, 2 * k, "a") for k in range(1000)} | {k: (k, -k, "b") for k in some}
    assert rows(store.read(1)) == sorted(want.values())
    assert rows(change.went) == sorted((k, 2 * k, "a") for k in some)
    assert store.read(0).filter("w = 'b'").count() == 0


def test_update_mode_new_keys_repeats_and_replay(spark, tmp_path):
    store = table(spark, tmp_path, 20)
    updates = spark.createDataFrame([(1, 7, 0), (1, 8, 1), (500, 9, 0)], "k bigint, v bigint, seq int")
    for _ in range(2):  # a write that is repeated repeats its answer
        store.upsert(updates, 1, "update", order=["seq"])
        got = {r.k: (r.v, r.w) for r in store.read(1).collect()}
        assert got[1] == (8, "a") and got[500] == (9, None) and len(got) == 21
    assert rows(store.lookup(1, spark.createDataFrame([(500,), (3,), (3,), (999,)], "k bigint")).select("k")) == [(3,), (500,)]


def test_delete_grow_and_vacuum(spark, tmp_path):
    store = table(spark, tmp_path, 100, 4)
    store.delete(spark.range(0, 100, 2).withColumnRenamed("id", "k"), 1)
    assert [r[0] for r in rows(store.read(1))] == list(range(1, 100, 2))
    store.grow(2, 4)
    again = Buckets(spark, store.root, ["k"])
    assert rows(again.read(2)) == rows(store.read(1)) and again.count == 16
    assert store.vacuum(2, 2) == 8 and not os.path.exists(f"{store.root}/manifest/v=0")
    assert again.read(2).count() == 50


def test_empty_table_null_keys_and_hot_keys(spark, tmp_path):
    store = Buckets(spark, str(tmp_path / "e"), ["k"], 4)
    store.overwrite(spark.createDataFrame([], "k string, v int"), 0)
    assert store.read(0).collect() == []
    hot = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").cast("int").alias("v"))
    store.upsert(hot, 1, order=["v"])
    got = dict(store.read(1).collect())
    assert got["hot"] == 4998 and len(got) == 3334
    store.upsert(spark.createDataFrame([], "k string, v int"), 2)
    assert rows(store.read(2)) == rows(store.read(1)) and not os.path.exists(store._data(2) + "/bucket=0")
    # A null key is a key that equals no other: it is kept and never replaced.
    store.upsert(spark.createDataFrame([(None, 1)], "k string, v int"), 3)
    store.upsert(spark.createDataFrame([(None, 2)], "k string, v int"), 4)
    assert sorted(r.v for r in store.read(4).filter("k IS NULL").collect()) == [1, 2]


def test_gold_by_deltas_is_gold_from_all(spark, tmp_path):
    schema = "ref_number string, platform_name string, method string, status string, amount double"
    old = [("a", "p", "x", "SUCCESS", 0.1), ("b", "p", None, "FAILED", 0.2), ("c", "q", "x", "SUCCESS", 1e300), ("d", "q", "y", None, None)]
    new = [("a", "q", "x", "FAILED", 0.3), ("c", "q", "x", "SUCCESS", 5.0), ("e", "r", "z", "SUCCESS", 7.0)]
    before, came = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    went = before.join(came.select("ref_number"), "ref_number", "left_semi").select(*before.columns)
    parts = gold.add_parts(gold.gold_parts(before), gold.gold_parts(came), gold.gold_parts(went))
    after = tables.upsert(before, came, ["ref_number"])
    key = lambda r: tuple((x is None, x) for x in r)
    for kept, whole in ((gold.channels_from(parts), gold.gold_payment_channels(after)),
                        (gold.platforms_from(parts), gold.gold_platform_metrics(after).drop("avg_amount"))):
        assert sorted(map(tuple, kept.collect()), key=key) == sorted(map(tuple, whole.select(*kept.columns).collect()), key=key)


@pytest.mark.parametrize("version", [1, 2])
def test_load_touches_the_buckets_of_its_references(spark, tmp_path, version):
    root = str(tmp_path / "load")
    base = {"platform_name": "p", "user_id": "u", "method": "m", "type": "t", "status": "SUCCESS", "timestamp": "2024-01-01T00:00:00", "raw_text": "a@b"}
    make = lambda refs, amount: spark.createDataFrame([(r, amount) for r in refs], "ref_number string, amount string").withColumns(
        {c: F.lit(v) for c, v in base.items()} | {"seq": F.lit(1)})
    batch_etl.run(make([f"R{i}" for i in range(300)], "2"), root, 0, [F.col("seq")])
    for v in range(1, version + 1):
        batch_etl.run(make(["R7"], "5"), root, v, [F.col("seq")])
    assert len([d for d in os.listdir(f"{root}/silver/data/v={version}") if d.startswith("bucket=")]) == 1
    got = tables.read_version(spark, f"{root}/gold_payment_channels", version).first()
    assert (got["volume"], got["total_transactions"]) == (603.0, 300)
    assert tables.read_version(spark, f"{root}/silver", version).agg(F.sum("amount")).first()[0] == 603.0
