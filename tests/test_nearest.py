"""Exact search where bounds leave out nothing and vectors repeat, as those of the seeded encoder do."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paystrata.operators import nearest, vector


def frame(spark, name, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"{name} string, vector array<float>")


def brute(index, queries, k, threshold):
    """Rows (query_id, id, rank): the best k of all rows that ask under one id, ties by id, a null id first."""
    out = []
    for name in dict.fromkeys(q for q, _ in queries):
        d = sorted((float(((np.float32(v).astype("f8") - np.float32(qv).astype("f8")) ** 2).sum()), i is not None, i or "")
                   for i, v in index if v is not None for q, qv in queries if q == name and qv is not None)
        out += [(name, i if known else None, n + 1) for n, (dist, known, i) in enumerate(d[:k]) if dist <= threshold]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes, threshold", [(1 << 25, 1e9), (1 << 25, 1.8), (700, 1.8), (700, 1e9)])
def test_repeats_nulls_and_unit_vectors(spark, block_bytes, threshold):
    rng = np.random.RandomState(4)
    some = [v / np.linalg.norm(v) for v in rng.randn(40, 30)]
    index = [(f"i{n:03d}", some[n * n % 40]) for n in range(300)] + [(None, some[1]), (None, some[1]), ("i001", some[1]), ("none", None)]
    queries = [(f"q{n:02d}", v / np.linalg.norm(v)) for n, v in enumerate(rng.randn(25, 30))]
    queries += [("same", some[1]), ("again", some[1]), ("q03", some[2]), queries[5], ("none", None)]
    got = vector.similarity_search(frame(spark, "id", index).repartition(3), frame(spark, "query_id", queries).repartition(2), 4, threshold, block_bytes)
    assert sorted([(r["query_id"], r["id"], r["rank"]) for r in got.collect()], key=str) == brute(index, queries, 4, threshold)


def test_equal_vectors_are_measured_once(spark):
    """What is searched follows the different vectors; all rows are still accounted for."""
    index = vector.encode_records(spark.range(4000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("text "), (F.col("id") % 30).cast("string")).alias("content")))
    cells = nearest.Cells(index.select("id", "vector"))
    different = len({sum(map(ord, f"text {n}")) for n in range(30)})
    assert cells.index.count() == different and cells.sizes.sum() == cells.rows == 4000
    asked = spark.range(200).select(F.col("id").cast("string").alias("query_id"), vector.encode(F.lit("text 7")).alias("vector"))
    hits, visits = cells.search(asked, 3, 1.8)
    assert hits.groupBy("query_id").count().filter("count = 3").count() == 200
    assert {r.measured + r.left_out for r in cells.skipped(visits).collect()} == {4000}


def test_encoder_runs_once_for_a_row_and_makes_one_generator_a_batch(spark, monkeypatch):
    calls, made = spark.sparkContext.accumulator(0), []

    def model(texts):
        calls.add(len(texts))
        return texts.map(lambda t: [float(len(t)), 1.0])

    index = spark.range(50).select(F.col("id").cast("string").alias("id"), vector.encode(F.repeat(F.lit("x"), F.col("id").cast("int")), model=model).alias("vector"))
    nearest.Cells(index)
    assert calls.value == 50
    expected = [vector.unit_normals(s, 20) for s in range(6)]
    one = np.random.RandomState
    monkeypatch.setattr(np.random, "RandomState", lambda *a: made.append(a) or one(*a))
    generator = np.random.RandomState()
    assert all((vector.unit_normals(s, 20, generator) == v).all() for s, v in enumerate(expected)) and len(made) == 1


def test_search_of_many_cells_does_not_loop_over_queries(spark, monkeypatch):
    """A task measures a cell for all its visitors by one product."""
    rng = np.random.RandomState(5)
    block, queries = rng.randn(600, 16), rng.randn(200, 16)
    cell = np.sort(rng.randint(0, 5, 600))
    calls, nonzero = [], np.nonzero
    monkeypatch.setattr(np, "nonzero", lambda x: calls.append(1) or nonzero(x))
    q, row, distance = nearest.measured(block, np.arange(600), cell, queries, np.ones((200, 5), dtype=bool), np.full(200, np.inf), 3)
    monkeypatch.undo()
    assert len(calls) < 20  # one for each cell and one each for its visitors
    gaps = ((queries[:, None] - block[None]) ** 2).sum(2)
    assert (row.reshape(200, 3) == np.argsort(gaps, axis=1)[:, :3]).all() and np.allclose(distance.reshape(200, 3), np.sort(gaps, axis=1)[:, :3])
    assert len(q) == 600
