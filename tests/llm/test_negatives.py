"""Hard negatives: bounds hold, cells against brute force, edge rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from paystrata.llm import negatives as N
from paystrata.llm.common import Scratch


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_bounds_hold_for_every_pair(dim):
    rng = np.random.default_rng(dim)
    v = np.floor(256 * rng.standard_normal((300, dim)))
    v[0] = 0
    v[1] = v[2]
    low, high = N.bounds(v[:40], *N.encode(v))
    true = v[:40] @ v.T
    assert (low <= true).all() and (true <= high).all()


def test_intervals_leave_rows_out():
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((20, 32))
    v = np.floor(256 * (centres[rng.integers(0, 20, 4000)] + 0.1 * rng.standard_normal((4000, 32))))
    low, high = N.bounds(v[:20], *N.encode(v))
    kept = np.mean([(h >= N._least_of_best(x, 5)).mean() for x, h in zip(low, high)])
    assert kept < 0.2


def brute(rows, step=4):
    out = []
    rows = list(dict.fromkeys((i, lab, tuple(v)) for i, lab, v in rows))
    far = lambda r: (r[0] is None, r[0])
    for a in rows:
        if a[0] is None or a[0] % step:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], r[2])), far(r), r) for r in rows if r[0] != a[0] and len(r[2]) == len(a[2])]
        scored.sort(key=lambda s: s[:2])
        for p, _, pr in [s for s in scored if s[2][1] == a[1]][:5]:
            fits = [s for s in scored if s[2][1] != a[1] and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(a[0], pr[0], k, s[2][0], -p, -s[0]) for k, s in enumerate(fits[:10], 1)]
    return sorted(out, key=repr)


def mined(spark, data, monkeypatch, tile=8, block=3):
    monkeypatch.setattr(N, "TILE_ROWS", tile)
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, lab int, id string, tile int, label string, score int")
    rows = N.integer_rows(frame, "vec_id", "embedding", F.col("lab"))
    return sorted(map(tuple, N.mine(rows, F.col("id") % 4 == 0, Scratch(spark)).collect()), key=repr)


def test_rows_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    extra = ("x", 1, "y", 2)
    good, data = [], []
    for i in range(60):
        v = np.round(rng.standard_normal(5), 2).astype("float32").tolist()
        good.append((i, int(rng.integers(0, 3)), v))
    good += [(100 + i, 1, good[8][2]) for i in range(12)]                      # ties
    good += [good[4], (None, 1, good[8][2]), (24, 0, good[9][2]), (200, 1, [1.0, 2.0]), (201, 1, [1.0, 2.0]), (202, 0, [0.5, 1.0])]
    data = [(i, v, lab, *extra) for i, lab, v in good]
    data += [(300, None, 1, *extra), (304, [], 1, *extra), (308, [1.0, None, 1.0, 1.0, 1.0], 1, *extra), (312, good[8][2], None, *extra),
             (316, [float("nan")] * 5, 1, *extra), (320, [float("inf")] * 5, 1, *extra)]
    ints = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in good]
    assert mined(spark, data, monkeypatch) == brute(ints)


def test_empty_tables(spark, monkeypatch):
    extra = ("x", 1, "y", 2)
    assert mined(spark, [], monkeypatch) == []
    assert mined(spark, [(1, [1.0], 1, *extra), (2, [1.0], 1, *extra)], monkeypatch) == []
