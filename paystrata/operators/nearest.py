"""Exact nearest vectors: pivots, cells, and bounds that leave out cells no answer can be in.

Equal vectors are measured once: a row keeps the key of its vector, a vector its least id,
and the rows of the best vectors are looked up by key at the end. At most ``PIVOTS`` centres
are fitted on a bounded sample of the index. Every vector belongs to the cell of its nearest
centre, and a cell knows the least and the largest distance of its members from it. A query
first measures its own cell, which bounds its k-th distance from above. Any other cell is
measured only if neither bound excludes it:

* triangle: a member is at least ``d(q, c) - largest`` and ``least - d(q, c)`` away;
* bisector: a member of c is no nearer to the query's own centre h, so it is at least
  ``(d(q, c)^2 - d(q, h)^2) / (2 d(c, h))`` away.

The bounds decide only what is left out; what is measured is measured exactly, so the
result does not depend on the centres. Small cells share a tile and a large one is dealt
into several, all of bounded size, and so are the queries that visit a tile: a task holds
one tile of each, and measures the cells of its tile for the queries that visit them.

Distances are squared. Rows without a vector take no part; vectors of one length are
expected. Ties go to the smaller id, repeated rows each count, and without index rows or
queries there are no hits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.operators.dedup import top_per_group
from paystrata.session import materialize

#: Largest number of centres, and bytes of them; both go to every task.
PIVOTS, PIVOT_BYTES = 256, 4 << 20
#: Index rows a centre is fitted on.
SAMPLE_PER_PIVOT = 8
#: Bytes of vectors in a tile.
BLOCK_BYTES = 32 << 20
#: Vectors that a task remembers as sent.
SEEN = 250_000
#: Queries and rows of one matrix product, and pairs that are measured at a time.
_TILE, _ROWS, _PAIRS = 256, 4096, 4096


def measured(block: np.ndarray, order: np.ndarray, cell: np.ndarray, queries: np.ndarray, visit: np.ndarray, limit: np.ndarray,
             k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, positions and squared distances of the best ``k`` rows for each query, no farther than its
    ``limit``, ties by ``order``. ``cell`` of the rows is sorted; ``visit`` says which cells a query measures.

    Matrix products rank roughly; every row within rounding distance of the limit or of the
    k-th so far is measured again by subtraction, so the result is exact. Products and pairs
    go in tiles of a few megabytes.
    """
    norms, own = np.einsum("ij,ij->i", block, block), np.einsum("ij,ij->i", queries, queries)
    slack = 1e-9 * (own + norms.max())
    best, place, row = np.full((len(queries), k), np.inf), np.full((len(queries), k), len(block)), np.full((len(queries), k), -1)
    bound = np.array(limit, dtype="float64")
    kinds, starts = np.unique(cell, return_index=True)
    for c, low, high in zip(kinds.tolist(), starts.tolist(), [*starts[1:].tolist(), len(cell)]):
        visitors = np.flatnonzero(visit[:, c])
        for at in range(0, len(visitors), _TILE):
            part = visitors[at:at + _TILE]
            tile = queries[part]
            for first in range(low, high, _ROWS):
                rows = slice(first, min(first + _ROWS, high))
                rough = own[part][:, None] + norms[rows][None, :] - 2.0 * tile @ block[rows].T
                near = rough <= (bound[part] + slack[part])[:, None]
                if rough.shape[1] > k and near.sum() > 4 * k * len(part):
                    near &= rough <= (np.partition(rough, k - 1, axis=1)[:, k - 1] + slack[part])[:, None]
                q, x = np.nonzero(near)
                if not len(q):
                    continue
                x += first
                exact = np.empty(len(q))
                for pair in range(0, len(q), _PAIRS):
                    some = slice(pair, pair + _PAIRS)
                    gap = block[x[some]] - tile[q[some]]
                    exact[some] = (gap * gap).sum(axis=1)
                # The best so far of each query and the new ones, in order; the first k of a query stay.
                q = np.concatenate((np.repeat(np.arange(len(part)), k), q))
                exact, ties, x = (np.concatenate((old[part].ravel(), new)) for old, new in ((best, exact), (place, order[x]), (row, x)))
                sort = np.lexsort((ties, exact, q))
                sort = sort[np.searchsorted(q[sort], np.arange(len(part)))[:, None] + np.arange(k)]
                best[part], row[part], place[part] = exact[sort], x[sort], ties[sort]
                bound[part] = np.minimum(bound[part], best[part, k - 1])
    q, nth = np.nonzero((row >= 0) & (best <= np.asarray(limit)[:, None]))
    return q, row[q, nth], best[q, nth]


def from_points(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows from points."""
    squared = np.einsum("ij,ij->i", x, x)[:, None] - 2.0 * x @ points.T + np.einsum("ij,ij->i", points, points)
    return np.sqrt(np.maximum(squared, 0.0))


def centres(sample: np.ndarray, k: int, rounds: int = 4) -> np.ndarray:
    """Farthest points of the sample, then a few rounds of means."""
    points, gap = [sample[0]], np.full(len(sample), np.inf)
    while len(points) < k:
        gap = np.minimum(gap, from_points(sample, points[-1][None, :])[:, 0])
        far = int(np.argmax(gap))
        if not gap[far] > 0:  # no more different vectors
            break
        points.append(sample[far])
    found = np.array(points)
    for _ in range(rounds):
        own = from_points(sample, found).argmin(1)
        found = np.array([sample[own == j].mean(0) if (own == j).any() else found[j] for j in range(len(found))])
    return found


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(vectors), len(flat) // max(len(vectors), 1))


def _keyed(df: DataFrame) -> DataFrame:
    """Rows with a vector, and its key; the vector itself stays on the first row of a task that has it.

    Rows without one leave here: a filter before would run an encoder upstream once more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            at = batch.schema.names.index("vector")
            batch = batch.filter(batch.column(at).is_valid())
            flat, ends = batch.column(at).flatten(), np.cumsum(pa.compute.list_value_length(batch.column(at)).to_numpy())
            data, keys, sent = memoryview(flat.to_numpy(zero_copy_only=False).tobytes()), [], []
            size, start = flat.type.bit_width // 8, 0
            for i, end in enumerate(ends.tolist()):
                key = hashlib.blake2b(data[start * size:end * size], digest_size=16).digest()
                sent.append(None if key in seen else i)
                seen.add(key)
                keys.append(key)
                start = end
            if len(seen) > SEEN:
                seen.clear()
            columns = [*batch.columns]
            columns[at] = columns[at].take(pa.array(sent, pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, "key"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("key", T.BinaryType())]))


def _in_cells(df: DataFrame, points: np.ndarray) -> DataFrame:
    """Adds the cell and the distance from its centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                gap = from_points(_matrix(batch.column(batch.schema.names.index("vector"))), points)
                own = gap.argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype("int32")), pa.array(gap[np.arange(len(own)), own])],
                                                 names=[*batch.schema.names, "cell", "radius"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType())]))


def _ranks(ids: list) -> np.ndarray:
    """Place of each id in ascending order, nulls first."""
    rank = np.empty(len(ids), dtype="int64")
    rank[sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))] = np.arange(len(ids))
    return rank


class Cells:
    """An index in cells. ``index`` has (id, vector); it is written once, with each vector's cell."""

    def __init__(self, index: DataFrame, block_bytes: int = BLOCK_BYTES, pivots: int = PIVOTS):
        self.spark, self.block_bytes = index.sparkSession, block_bytes
        self.ids = materialize(_keyed(index.select("id", "vector")), "index")
        # The different vectors, with their least id (a null is less than others) and their rows.
        different = materialize(self.ids.groupBy("key").agg(
            F.first("vector", True).alias("vector"), F.min(F.struct("id")).alias("least"), F.count(F.lit(1)).alias("n"),
        ).select("key", "vector", F.col("least.id").alias("id"), "n"), "different")
        shape = different.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
        self.rows, self.bytes = shape.rows or 0, 8 * (shape.width or 1)
        self.points = self.least = self.largest = self.sizes = self.tiles = None
        if not self.rows:
            return
        k = max(1, min(pivots, math.isqrt(shape.n), PIVOT_BYTES // self.bytes))
        # At most PIVOTS * SAMPLE_PER_PIVOT vectors, by least hash; each task sends no more than that.
        sample = different.select("key", "vector").orderBy(F.xxhash64("key"), "key").limit(k * SAMPLE_PER_PIVOT).collect()
        self.points = centres(np.array([r.vector for r in sample], dtype="float64"), k)
        self.index = materialize(_in_cells(different, self.points), "cells")
        cells = len(self.points)
        self.sizes, self.least, self.largest, vectors = np.zeros(cells, dtype="int64"), np.zeros(cells), np.zeros(cells), np.zeros(cells, dtype="int64")
        for r in self.index.groupBy("cell").agg(F.count(F.lit(1)).alias("vectors"), F.sum("n").alias("n"), F.min("radius").alias("low"), F.max("radius").alias("high")).collect():
            vectors[r.cell], self.sizes[r.cell], self.least[r.cell], self.largest[r.cell] = r.vectors, r.n, r.low, r.high
        self.tiles = self._tiles(vectors)

    def _tiles(self, vectors: np.ndarray) -> list[tuple[int, int]]:
        """First tile and number of tiles of each cell: small cells share one, a large one has several."""
        room, out, at, filled = max(1, self.block_bytes // self.bytes), [], 0, 0
        for n in vectors.tolist():
            if filled and filled + n > room:
                at, filled = at + 1, 0
            many = max(1, -(-n // room))
            out.append((at, many))
            at, filled = (at + many, 0) if many > 1 else (at, filled + n)
        return out

    def _hits(self, visits: DataFrame, asked: DataFrame, k: int, threshold: float, home: bool) -> DataFrame:
        """(query, key, id, distance): the best ``k`` vectors of every tile that a query visits, by their least id.

        ``visits`` has (query, tile); ``asked`` has (query, vector, cell, limit). ``home`` measures a query's own
        cell, else the others that the bounds let in.
        """
        counts = {r.tile: r.n for r in visits.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a tile
        turns = F.broadcast(self.spark.createDataFrame([(t, max(1, -(-n * self.bytes // self.block_bytes))) for t, n in counts.items()], "tile int, turns int"))
        places = F.broadcast(self.spark.createDataFrame([(c, *t) for c, t in enumerate(self.tiles)], "cell int, tile int, many int"))
        deal = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        held = (self.index.join(places, "cell").withColumn("tile", F.col("tile") + deal("key", "many")).join(turns, "tile")
                .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))))
        asking = visits.join(turns, "tile").withColumn("turn", deal("query", "turns")).join(asked, "query")
        names = ["query", "key", "id", "distance"]
        kind = self.index.schema["id"].dataType
        out = T.StructType([T.StructField("query", T.BinaryType()), T.StructField("key", T.BinaryType()), T.StructField("id", kind), T.StructField("distance", T.DoubleType())])
        let_in = self._let_in()

        def tile(own: pa.Table, queries: pa.Table) -> pa.Table:
            if not own.num_rows or not queries.num_rows:
                return pa.table([own["key"][:0], own["key"][:0], own["id"][:0], pa.array([], pa.float64())], names=names)
            own = own.take(pa.compute.sort_indices(own, [("cell", "ascending")]))
            block, asked_ = (_matrix(x["vector"].combine_chunks()) for x in (own, queries))
            nearer = np.minimum(queries["limit"].to_numpy(), threshold)
            homes = queries["cell"].to_numpy()
            visit = homes[:, None] == np.arange(len(self_sizes)) if home else let_in(asked_, homes, nearer)
            q, row, distance = measured(block, _ranks(own["id"].to_pylist()), own["cell"].to_numpy(), asked_, visit, nearer, k)
            return pa.table([queries["query"].take(pa.array(q)), own["key"].take(pa.array(row)), own["id"].take(pa.array(row)), pa.array(distance)], names=names)

        self_sizes = self.sizes
        keys = ["tile", "turn"]
        return (held.select(*keys, "key", "id", "vector", "cell").groupBy(*keys)
                .cogroup(asking.select(*keys, "query", "vector", "cell", "limit").groupBy(*keys)).applyInArrow(tile, out))

    def _let_in(self):
        """Function of (vectors, own cells, limits): which cells, but the own one, may hold a row no farther than the limit."""
        points, least, largest, sizes = self.points, self.least, self.largest, self.sizes
        between = from_points(points, points)
        # Rounding of distances taken from products and of bounds; it only lets more cells in.
        slack = 1e-6 * (1.0 + float(np.abs(points).max()) * math.sqrt(points.shape[1]))

        def let_in(x: np.ndarray, own: np.ndarray, limit: np.ndarray) -> np.ndarray:
            visit, limit = np.empty((len(x), len(points)), dtype=bool), np.sqrt(limit)
            for at in range(0, len(x), _TILE):
                part, home = slice(at, at + _TILE), own[at:at + _TILE]
                gap = from_points(x[part], points)
                rows = np.arange(len(home))
                mine = gap[rows, home][:, None]
                with np.errstate(divide="ignore", invalid="ignore"):
                    bisector = np.where(between[home] > 0, (gap * gap - mine * mine) / (2 * between[home]), 0.0)
                bound = np.maximum(np.maximum(gap - largest, least - gap), bisector) - slack * (1.0 + mine)
                visit[part] = ~(bound > limit[part][:, None]) & (sizes > 0)
                visit[part][rows, home] = False
            return visit

        return let_in

    def _others(self, asked: DataFrame, threshold: float, tiles: bool) -> DataFrame:
        """(query, tile) or (query, cell): visits of the cells, but a query's own, that may hold a row nearer than its ``limit``."""
        let_in, of = self._let_in(), self.tiles
        name = "tile" if tiles else "cell"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = dict(zip(batch.schema.names, batch.columns))
                visit = let_in(_matrix(column["vector"]), column["cell"].to_numpy(), np.minimum(column["limit"].to_numpy(), threshold))
                found = [np.flatnonzero(v).tolist() for v in visit]
                if tiles:
                    found = [sorted({t for c in cells for t in range(of[c][0], sum(of[c]))}) for cells in found]
                yield pa.RecordBatch.from_arrays([column["query"], pa.array(found, pa.list_(pa.int32()))], names=["query", "listed"])

        listed = asked.select("query", "vector", "cell", "limit").mapInArrow(run, "query binary, listed array<int>")
        return listed.select("query", F.explode("listed").alias(name))

    def search(self, queries: DataFrame, k: int, threshold: float) -> tuple[DataFrame, DataFrame]:
        """Hits (query_id, id, distance, rank), and visits (query_id, row, cell) that were measured for them."""
        queries = queries.select("query_id", "vector")
        if not self.rows:
            none = self.spark.createDataFrame([], T.StructType([queries.schema["query_id"], T.StructField("row", T.LongType()), T.StructField("cell", T.IntegerType())]))
            return none.select("query_id", F.lit(None).cast("string").alias("id"), F.lit(0.0).alias("distance"), F.lit(0).alias("rank")), none
        rows = materialize(_keyed(queries.withColumn("row", F.monotonically_increasing_id())).withColumnRenamed("key", "query"), "queries")
        different = rows.filter(F.col("vector").isNotNull()).select("query", "vector").dropDuplicates(["query"])
        asked = materialize(_in_cells(different, self.points), "asked")
        order = [F.col("distance"), F.col("id")]
        # The best k vectors of a query in its own cell: few rows, written because both the bound and the result need them.
        places = F.broadcast(self.spark.createDataFrame([(c, list(range(t, t + n))) for c, (t, n) in enumerate(self.tiles)], "cell int, tiles array<int>"))
        home = asked.join(places, "cell").select("query", F.explode("tiles").alias("tile"))
        unbounded = asked.withColumn("limit", F.lit(float("inf")))
        first = materialize(top_per_group(self._hits(home, unbounded, k, threshold, True), ["query"], order, k).drop("rank"), "own_cell")
        kth = first.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("limit"))
        limited = asked.join(kth, "query", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
        others = materialize(self._others(limited, threshold, True), "visits")
        second = self._hits(others, limited, k, threshold, False)
        best = top_per_group(first.unionByName(second), ["query"], order, k).select("query", "key", "distance")
        # The rows of the best vectors, for every row that asks with the query's vector.
        named = top_per_group(self.ids.select("key", "id"), ["key"], [F.col("id")], k).drop("rank")
        answers = top_per_group(best.join(named, "key"), ["query"], order, k).select("query", "id", "distance")
        asking = rows.select("query_id", "row", "query")
        hits = top_per_group(asking.select("query_id", "query").join(answers, "query").drop("query"), ["query_id"], order, k)
        visits = asked.select("query", "cell").unionByName(self._others(limited, threshold, False))
        return hits.select("query_id", "id", "distance", "rank"), asking.join(visits, "query").select("query_id", "row", "cell")

    def skipped(self, visits: DataFrame) -> DataFrame:
        """(query_id, measured, left_out): index rows that a query's visits measured, and those the bounds left out."""
        if not self.rows:
            return visits.select("query_id", F.lit(0).cast("bigint").alias("measured"), F.lit(0).cast("bigint").alias("left_out"))
        sizes = F.broadcast(self.spark.createDataFrame([(i, int(n)) for i, n in enumerate(self.sizes)], "cell int, n bigint"))
        per = visits.select("query_id", "row", "cell").join(sizes, "cell").groupBy("query_id", "row").agg(F.sum("n").alias("measured"))
        return per.select("query_id", "measured", (F.lit(self.rows) - F.col("measured")).alias("left_out"))
