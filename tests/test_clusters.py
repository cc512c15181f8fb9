"""k-means with all restarts in the same passes."""

import numpy as np
import pytest

from paystrata.operators import clusters


def frame(spark, rows):
    return spark.createDataFrame([tuple(map(lambda v: None if v is None else float(v), r)) for r in rows], "a double, b double")


def blobs(seed=0):
    rng = np.random.RandomState(seed)
    return np.concatenate([rng.randn(60, 2) + at for at in ((0, 0), (40, 0), (0, 40))])


def lloyd(x, centres, steps):
    for turn in range(steps + 1):
        gaps = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        near, inertia = gaps.argmin(axis=1), gaps.min(axis=1).sum()
        if turn < steps:
            centres = np.array([x[near == j].mean(axis=0) if (near == j).any() else c for j, c in enumerate(centres)])
    return centres, near, inertia


def test_every_run_is_lloyds_algorithm(spark):
    x = np.concatenate([blobs(), np.repeat([[3.0, 3.0]], 90, axis=0)])  # a third of the rows are one point
    starts = [x[[0, 1, 2]], x[[0, 60, 120]], np.array([[0.0, 0.0], [1.0, 1.0], [900.0, 900.0]])]
    wanted = [lloyd(x, s, 4) for s in starts]
    for run, (centres, near, inertia) in enumerate(wanted):
        got = clusters.fit(frame(spark, x).repartition(5), ["a", "b"], 3, 1, 0, [starts[run]], 4, 0.0)
        assert np.allclose(got.centres, centres) and got.inertia == pytest.approx(inertia)
        assert [r[0] for r in got.transform(frame(spark, x)).select("prediction").collect()] == near.tolist()
    together = clusters.fit(frame(spark, x), ["a", "b"], 3, 3, 0, starts, 4, 0.0)
    best = min(range(3), key=lambda r: wanted[r][2])
    assert np.allclose(together.centres, wanted[best][0]) and together.inertia == pytest.approx(wanted[best][2])


def test_drawn_starts_find_the_blobs_and_do_not_depend_on_the_partitions(spark):
    x = blobs(1)
    one = clusters.fit(frame(spark, x).repartition(7), ["a", "b"], 3, 4, 5)
    two = clusters.fit(frame(spark, x[::-1]).coalesce(1), ["a", "b"], 3, 4, 5)
    assert np.allclose(one.centres, two.centres) and one.inertia == pytest.approx(two.inertia)
    sizes = sorted(r["count"] for r in one.transform(frame(spark, x)).groupBy("prediction").count().collect())
    assert sizes == [60, 60, 60]


def test_seeds_are_drawn_by_weight(spark):
    """With one draw a point is taken about as often as it has rows."""
    points = clusters.weighted_points(frame(spark, [(0, 0)] * 90 + [(1, 1)] * 10), ["a", "b"])
    drawn = clusters._race(points, [np.zeros((0, 2))] * 400, 2, 1, list(range(400)))
    assert 0.84 < np.mean([d[0][0] == 0 for d in drawn]) < 0.96


def test_nulls_few_points_and_empty_tables(spark):
    rows = [(1, 1), (1, 1), (5, 5), (None, 2), (float("nan"), 2), (2, float("inf"))]
    got = clusters.fit(frame(spark, rows), ["a", "b"], 3, 2, 0)
    assert sorted(map(tuple, got.centres.tolist())) == [(1.0, 1.0), (5.0, 5.0)] and got.inertia == 0.0
    out = [r[0] for r in got.transform(frame(spark, rows)).select("prediction").collect()]
    assert out[0] == out[1] != out[2] and out[3:] == [None] * 3
    none = clusters.fit(frame(spark, rows).limit(0), ["a", "b"], 3, 2, 0)
    assert len(none.centres) == 0 and none.inertia == 0.0
    assert none.transform(frame(spark, rows)).filter("prediction IS NOT NULL").count() == 0


def test_transform_has_no_python(spark):
    got = clusters.Clusters(["a", "b"], np.array([[0.0, 0.0], [9.0, 9.0]]), 0.0)
    plan = got.transform(frame(spark, [(1, 1)]).repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
