"""k-means whose restarts move together: one pass over the points an iteration, for all of them.

Equal points are folded into one with a weight first, so a value that a third of the rows
share is one row. Starting centres come from k-means|| (Bahmani et al., 2012): each round
draws ``OVERSAMPLING * k`` points a restart with a chance proportional to weight times
squared distance, as a race of exponential variables (the least ``-log(u) / chance`` win),
which needs no total beforehand and a bounded number of rows from each task. The candidates,
weighted by the points nearest to them, are reduced to ``k`` by k-means++ on the driver:
``restarts * (1 + ROUNDS * OVERSAMPLING * k)`` rows at most, whatever the table holds.

Rows where a column is null, NaN or infinite take no part and are predicted null. With fewer
different points than ``k`` every point is a centre; an empty table has no centre and an
inertia of 0. A centre that loses its last point stays where it is. Ties go to the lower number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.operators.dedup import top_per_group
from paystrata.session import scratch

ROUNDS = 3
OVERSAMPLING = 2
ITERATIONS = 20
TOLERANCE = 1e-4
#: Numbers held at once by a task that measures points against centres.
CELLS = 1 << 20


@dataclass
class Clusters:
    """Fitted centres; ``transform`` is one expression, without Python."""

    columns: list[str]
    centres: np.ndarray
    inertia: float

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        if not len(self.centres):
            return df.withColumn(prediction, F.lit(None).cast("int"))
        gaps = [sum(((F.col(c).cast("double") - F.lit(float(v))) * (F.col(c).cast("double") - F.lit(float(v)))
                     for c, v in zip(self.columns, centre)), F.lit(0.0)) for centre in self.centres]
        nearest = F.transform(F.array(F.array(*gaps)), lambda d: F.array_position(d, F.array_min(d)) - 1)[0]
        return df.withColumn(prediction, F.when(_known(self.columns), nearest.cast("int")))


def _known(columns: list[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        value = F.col(c).cast("double")
        known = known & value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return known


def weighted_points(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, w, h): the different points, how many rows each stands for, and its hash."""
    # Adding 0.0 makes a negative zero the same point as zero.
    x = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in columns])
    return df.filter(_known(columns)).select(x.alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("w")).withColumn(
        "h", F.xxhash64("x"))


def _blocks(batches: Iterator[pa.RecordBatch], width: int, centres: int):
    """(points, weights, hashes) in blocks small enough to be measured against all centres."""
    step = max(1, CELLS // max(1, width * centres))
    for batch in batches:
        x = np.asarray(batch.column("x").flatten()).reshape(-1, width)
        w, h = (np.asarray(batch.column(c)) for c in ("w", "h"))
        for at in range(0, len(x), step):
            yield x[at:at + step], w[at:at + step], h[at:at + step]


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, by subtraction: no cancellation when the values are large."""
    diff = x[:, None, :] - centres[None, :, :]
    return np.einsum("ijk,ijk->ij", diff, diff)


def _uniform(h: np.ndarray, seed: int) -> np.ndarray:
    """A number in (0, 1) per point, from its hash and a seed (splitmix64)."""
    with np.errstate(over="ignore"):
        z = h.astype("int64").view("uint64") + np.uint64((seed * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype("float64") + 0.5) / float(1 << 53)


def _race(points: DataFrame, held: list[np.ndarray], width: int, take: int, seeds: list[int]) -> list[np.ndarray]:
    """Per restart up to ``take`` points drawn by weight times squared distance to ``held``
    (by weight alone where nothing is held)."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros((0, width))) for _ in seeds]
        for x, w, h in _blocks(batches, width, max(1, max(len(c) for c in held))):
            for r, seed in enumerate(seeds):
                chance = w * (_gaps(x, held[r]).min(axis=1) if len(held[r]) else 1.0)
                key = np.full(len(x), np.inf)
                np.divide(-np.log(_uniform(h, seed)), chance, out=key, where=chance > 0)
                keys, rows = np.concatenate([best[r][0], key]), np.concatenate([best[r][1], x])
                least = np.argsort(keys, kind="stable")[:take]
                least = least[np.isfinite(keys[least])]
                best[r] = keys[least], rows[least]
        for r, (keys, rows) in enumerate(best):
            yield pa.RecordBatch.from_pydict(
                {"restart": pa.array([r] * len(keys), pa.int32()), "key": pa.array(keys, pa.float64()),
                 "x": pa.array(rows.tolist(), pa.list_(pa.float64()))})

    drawn = points.mapInArrow(draw, "restart int, key double, x array<double>")
    rows = top_per_group(drawn, ["restart"], [F.col("key"), F.col("x")], take).orderBy("restart", "rank").collect()
    out: list[list] = [[] for _ in seeds]
    for row in rows:
        out[row["restart"]].append(row["x"])
    return [np.array(x, dtype="float64").reshape(-1, width) for x in out]


def _assign(points: DataFrame, held: dict[int, np.ndarray], width: int) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per restart: weight and sum of the points nearest to each centre, and the inertia."""
    sums = [f"s{i}" for i in range(width)]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {r: np.zeros((len(c), width + 2)) for r, c in held.items()}
        for x, w, _ in _blocks(batches, width, max(len(c) for c in held.values())):
            for r, centres in held.items():
                gaps = _gaps(x, centres)
                near = gaps.argmin(axis=1)
                parts = [w, w * gaps[np.arange(len(x)), near], *(w * x[:, i] for i in range(width))]
                for i, part in enumerate(parts):
                    total[r][:, i] += np.bincount(near, weights=part, minlength=len(centres))
        for r, t in total.items():
            yield pa.RecordBatch.from_pydict({
                "restart": pa.array([r] * len(t), pa.int32()), "cluster": pa.array(range(len(t)), pa.int32()),
                **{name: pa.array(t[:, i]) for i, name in enumerate(["weight", "cost", *sums])}})

    schema = "restart int, cluster int, " + ", ".join(f"{c} double" for c in ["weight", "cost", *sums])
    rows = points.mapInArrow(fold, schema).groupBy("restart", "cluster").agg(
        *[F.sum(c).alias(c) for c in ["weight", "cost", *sums]]).collect()
    out = {r: [np.zeros(len(c)), np.zeros((len(c), width)), 0.0] for r, c in held.items()}
    for row in rows:
        found = out[row["restart"]]
        found[0][row["cluster"]] = row["weight"]
        found[1][row["cluster"]] = [row[c] for c in sums]
        found[2] += row["cost"]
    return {r: tuple(v) for r, v in out.items()}


def _reduce(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over the weighted candidates."""
    rng = np.random.RandomState(seed % (1 << 32))
    chosen: list[int] = []
    chance = weights.astype("float64")
    while len(chosen) < k and chance.sum() > 0:
        chosen.append(int(rng.choice(len(candidates), p=chance / chance.sum())))
        chance = weights * _gaps(candidates, candidates[chosen]).min(axis=1)
    return candidates[chosen]


def seed_centres(points: DataFrame, width: int, k: int, seeds: list[int]) -> list[np.ndarray]:
    """Starting centres of every restart, by k-means||."""
    held = _race(points, [np.zeros((0, width))] * len(seeds), width, 1, seeds)
    for turn in range(1, ROUNDS + 1):
        drawn = _race(points, held, width, OVERSAMPLING * k, [s + turn * 1_000_003 for s in seeds])
        held = [np.concatenate(pair) for pair in zip(held, drawn)]
    if not len(held[0]):
        return held
    shares = _assign(points, dict(enumerate(held)), width)
    return [_reduce(held[r], shares[r][0], k, seed) for r, seed in enumerate(seeds)]


def fit(df: DataFrame, columns: list[str], k: int, restarts: int, seed: int, starts: list[np.ndarray] | None = None,
        iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> Clusters:
    """Best of ``restarts`` runs by inertia (ties: the first). ``starts`` gives the starting
    centres of every run instead of drawing them. A run whose centres all moved by
    ``tolerance`` or less is finished and no longer measured."""
    width = len(columns)
    with scratch(df.sparkSession) as keep:
        points = keep(weighted_points(df, columns), "points")
        held = [np.array(s, dtype="float64").reshape(-1, width) for s in starts] if starts is not None else \
            seed_centres(points, width, k, [seed + r for r in range(restarts)])
        moving = {r: c for r, c in enumerate(held) if len(c)}
        if not moving:
            return Clusters(columns, np.zeros((0, width)), 0.0)
        cost: dict[int, float] = {}
        for turn in range(iterations + 1):
            for r, (weight, total, inertia) in _assign(points, moving, width).items():
                cost[r] = inertia
                if turn == iterations:
                    continue
                centres = np.where(weight[:, None] > 0, total / np.maximum(weight, 1)[:, None], held[r])
                shift = float(np.sqrt(((centres - held[r]) ** 2).sum(axis=1)).max())
                if shift <= tolerance:
                    del moving[r]
                else:
                    held[r] = moving[r] = centres
            if not moving:
                break
    best = min(cost, key=lambda r: (cost[r], r))
    return Clusters(columns, held[best], cost[best])
