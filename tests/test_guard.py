"""Guarded batches: pills alone go, passing errors raise, all sinks or none."""

import pytest
from pyspark.sql import functions as F

from paystrata.sources.layers import Layers
from paystrata.streaming import guard

SCHEMAS = {"clean": "k bigint, amount double", "names": "k bigint", "dlq": guard.DEAD}


def transform(df):
    return {"clean": df.select("k", F.col("v").cast("double").alias("amount")), "names": df.select("k")}


def batch(spark, bad=(), n=40):
    return spark.createDataFrame([(i, "x1" if i in bad else str(i)) for i in range(n)], "k bigint, v string")


def run(spark, tmp_path, df, epoch=0, fn=transform, **options):
    store = Layers(spark, str(tmp_path / "s"), SCHEMAS)
    return store, guard.guarded(df, epoch, store, fn, "here", **{"wait": 0, "attempts": 1} | options)


@pytest.mark.parametrize("bad", [(), (17,), (0, 1, 39)])
def test_only_the_raising_rows_go(spark, tmp_path, bad):
    store, gone = run(spark, tmp_path, batch(spark, bad))
    assert gone == len(bad)
    assert sorted(r.k for r in store.read("clean").collect()) == [i for i in range(40) if i not in bad]
    assert store.read("names").count() == 40 - len(bad)
    letters = store.read("dlq").collect()
    assert sorted(r.failed_payload for r in letters) == [f'{{"k":{i},"v":"x1"}}' for i in bad]
    assert all("CAST_INVALID_INPUT" in r.error and r.origin == "here" for r in letters)


def test_python_errors_and_repeated_rows(spark, tmp_path):
    @F.udf("double")
    def strict(v):
        return float(v)
    fn = lambda df: {"clean": df.select("k", strict("v").alias("amount")), "names": df.select("k")}
    df = batch(spark, (5,), 10)
    store, gone = run(spark, tmp_path, df.unionAll(df.filter("k = 5")), fn=fn)
    assert gone == 1 and store.read("clean").count() == 9
    assert [r.error.split(":")[0] for r in store.read("dlq").collect()] == ["ValueError"] * 2


def test_passing_errors_are_tried_again_and_raised(spark, tmp_path):
    calls = []

    def flaky(df):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no route")
        return transform(df)
    store, gone = run(spark, tmp_path, batch(spark), fn=flaky, attempts=3)
    assert gone == 0 and len(calls) == 3 and store.read("clean").count() == 40

    def broken(df):
        raise OSError("no route")
    with pytest.raises(OSError):
        run(spark, tmp_path, batch(spark), 1, fn=broken, attempts=2)
    assert store.epochs() == [0] and store.read("clean").count() == 40


def test_a_faulty_transform_loses_nothing(spark, tmp_path):
    with pytest.raises(guard.TooManyFailures):
        run(spark, tmp_path, batch(spark, range(8), 8), most=3)
    assert Layers(spark, str(tmp_path / "s"), SCHEMAS).epochs() == []


def test_empty_batch_and_replay(spark, tmp_path):
    run(spark, tmp_path, batch(spark, (), 0))
    for _ in range(2):
        store, _ = run(spark, tmp_path, batch(spark, (2,), 5), 1)
    assert store.read("clean").count() == 4 and store.read("dlq").count() == 1
