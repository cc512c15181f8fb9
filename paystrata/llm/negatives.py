"""Hard negatives: rotated one-bit codes bound every inner product, survivors are scored in integers.

A vector's code is the sign of its components under ``ROTATIONS`` random rotations; the code
stands for the unit vector ``c`` that the signs add up to, and the index stores beside it the
vector's length and its alignment ``a`` with ``c``. For an anchor ``q`` the part of ``<q, v>``
along ``c`` follows from popcounts of the code under the bit planes of the rotated anchor;
what is left is orthogonal to ``c`` on both sides, so by Cauchy-Schwarz

    |<q, v> - |v| a <q, c>|  <=  |v| sqrt(1 - a^2) sqrt(|q|^2 - <q, c>^2)

holds always, not on average. Rows whose interval cannot reach the wanted ranks or the wanted
band are left out; for the others the inner product is taken in integers. The result is exact.

Rows are dealt by hash into tiles and anchors into blocks; each cell of the grid is one group
of bounded size, emits its best rows per anchor, and only those are ranked over all tiles, so
a label that holds any share of the rows is spread like the others.

Defined cases: rows with a null label, a null or empty vector, or a null or non-finite
component take no part. Rows equal in id, label and vector count once; several rows of one id
that differ each take part, and none of them is a candidate for an anchor of its own id. A
null id is never an anchor and comes last among ties. Vectors of different lengths have no
inner product and are not compared. An empty table gives no rows; other columns are ignored.
Components times 256 must fit into 32 bits, as scores are 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, column, worker_store
from paystrata.llm.registry import query
from paystrata.operators.dedup import top_per_group

#: Rotations a code is made of: more give a higher alignment and narrower intervals.
ROTATIONS = 16
#: Bits of a rotated anchor's component.
PLANES = 8
TILE_ROWS = 4096
BLOCK_ROWS = 512
#: Anchors a task bounds at once.
_AT_ONCE = 32
#: Stands for a null id, so that it sorts last.
_NO_ID = (1 << 63) - 1


def _rotations(dim: int) -> np.ndarray:
    """``ROTATIONS`` orthogonal matrices under one another, from a fixed seed."""
    store = worker_store("rotations")
    if dim not in store:
        rng = np.random.default_rng(dim)
        store[dim] = np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(ROTATIONS)])
    return store[dim]


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    pad = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, pad)))).view(np.uint64)


def _matrix(array: pa.Array, dim: int, kind=np.int32) -> np.ndarray:
    return np.frombuffer(b"".join(array.to_pylist()), dtype=kind).reshape(-1, dim)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code words, length, alignment with the code vector, and the code vector's length."""
    rotations = _rotations(vectors.shape[1])
    signs = vectors @ rotations.T >= 0
    spanned = np.where(signs, 1.0, -1.0) @ rotations
    length, reach = np.linalg.norm(vectors, axis=1), np.linalg.norm(spanned, axis=1)
    along = np.einsum("ij,ij->i", vectors, spanned)
    align = np.divide(along, length * reach, out=np.zeros(len(vectors)), where=length * reach > 0)
    return _words(signs), length, np.clip(align, 0.0, 1.0), reach


def bounds(anchors: np.ndarray, codes: np.ndarray, length: np.ndarray, align: np.ndarray, reach: np.ndarray):
    """Lower and upper bounds of all inner products, anchors by rows."""
    rotations = _rotations(anchors.shape[1])
    bits = len(rotations)
    turned = anchors @ rotations.T
    low = turned.min(axis=1, keepdims=True)
    step = (turned.max(axis=1, keepdims=True) - low) / ((1 << PLANES) - 1)
    level = np.rint(np.divide(turned - low, step, out=np.zeros_like(turned), where=step > 0)).astype(np.int64)
    under = np.zeros((len(anchors), len(codes)), dtype=np.int64)
    for plane in range(PLANES):
        words = _words((level >> plane & 1).astype(bool))
        for w in range(codes.shape[1]):
            under += np.bitwise_count(words[:, w, None] & codes[None, :, w]).astype(np.int64) << plane
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    # <turned, signs>: the levels under set bits count twice, less all of them.
    total = low * (2 * ones - bits)[None, :] + step * (2 * under - level.sum(axis=1)[:, None])
    blur = 0.5 * step * bits
    scale = np.divide(1.0, reach, out=np.zeros_like(reach), where=reach > 0)[None, :]
    along, off = total * scale, blur * scale
    square = np.einsum("ij,ij->i", anchors, anchors)[:, None]
    rest = np.sqrt(np.maximum(square - np.maximum(np.abs(along) - off, 0.0) ** 2, 0.0))
    half = length[None, :] * (align[None, :] * off + np.sqrt(1.0 - align[None, :] ** 2) * rest)
    # What rounding may add, far above it.
    half += 1e-7 * (1.0 + length[None, :] * np.sqrt(square))
    centre = length[None, :] * align[None, :] * along
    return centre - half, centre + half


def _least_of_best(lower: np.ndarray, k: int) -> float:
    """What ``k`` of the rows reach for certain."""
    return float(np.partition(lower, len(lower) - k)[len(lower) - k]) if len(lower) >= k else -np.inf


class _Held:
    """The rows of one tile as arrays."""

    def __init__(self, table: pa.Table):
        self.dim = table.column("dim")[0].as_py()
        ids = table.column("id").combine_chunks()
        self.ids = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        self.labels = table.column("label").to_numpy()
        ints = _matrix(table.column("ints"), self.dim)
        key = np.concatenate((self.ids.astype("<i8").view(np.uint8).reshape(-1, 8), self.labels.astype("<i8").view(np.uint8).reshape(-1, 8),
                              np.ascontiguousarray(ints).view(np.uint8).reshape(len(ints), -1)), axis=1)
        once = np.unique(np.ascontiguousarray(key).view([("", key.dtype, key.shape[1])]).ravel(), return_index=True)[1]
        self.ids, self.labels, self.ints = self.ids[once], self.labels[once], ints[once].astype(np.int64)
        self.codes = _matrix(table.column("code"), len(table.column("code")[0].as_py()) // 8, np.uint64)[once]
        self.length, self.align, self.reach = (table.column(c).to_numpy()[once] for c in ("length", "align", "reach"))

    def bounds(self, anchors: np.ndarray, at=slice(None)):
        return bounds(anchors.astype(np.float64), self.codes[at], self.length[at], self.align[at], self.reach[at])

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int):
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[order]], scores[order]


def _cells(tiles: int, blocks: int):
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = lambda df: df.withColumn("tile", F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int")).withColumn("block", every(blocks))
    right = lambda df: df.withColumn("block", F.pmod(F.xxhash64("id", "label", "ints"), F.lit(blocks)).cast("int")).withColumn("tile", every(tiles))
    return left, right


def integer_rows(df: DataFrame, id_col: str, vector: str, label: Column) -> DataFrame:
    """(id, label, dim, ints): the rows that take part, components as ``floor(256 x)``."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                     F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.filter(F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & finite).select(
        "id", "label", F.size("x").alias("dim"), F.transform("x", lambda v: F.floor(v * F.lit(256.0)).cast("int")).alias("ints"))


_INDEX = "id bigint, label bigint, dim int, ints binary, code binary, length double, align double, reach double"


def index(rows: DataFrame) -> DataFrame:
    """The rows of ``integer_rows`` with their codes."""
    def encoded(batches):
        for batch in batches:
            dims = column(batch, "dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                ints = column(part, "ints").flatten().to_numpy().reshape(-1, dim).astype(np.int32)
                codes, length, align, reach = encode(ints.astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "id").cast(pa.int64()), column(part, "label"), column(part, "dim"),
                     pa.array([r.tobytes() for r in ints], pa.binary()), pa.array([r.tobytes() for r in codes], pa.binary()),
                     pa.array(length), pa.array(align), pa.array(reach)],
                    ["id", "label", "dim", "ints", "code", "length", "align", "reach"])
    return rows.mapInArrow(encoded, _INDEX)


def _positives_of_cell(k: int):
    def cell(held: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"akey": [], "id": [], "score": []}
        if len(held) and len(asked):
            rows = _Held(held)
            anchors = _matrix(asked.column("ints"), rows.dim).astype(np.int64)
            keys, ids, labels = (asked.column(c).to_numpy() for c in ("akey", "id", "label"))
            for label in np.unique(labels):
                same, mine = np.flatnonzero(rows.labels == label), np.flatnonzero(labels == label)
                for start in range(0, len(mine), _AT_ONCE):
                    some = mine[start:start + _AT_ONCE]
                    for i, low, high in zip(some, *rows.bounds(anchors[some], same)):
                        rest = rows.ids[same] != ids[i]
                        near = same[rest & (high >= _least_of_best(low[rest], k))]
                        found, scores = rows.best(near, rows.ints[near] @ anchors[i], k)
                        out["akey"] += [keys[i]] * len(found)
                        out["id"] += found.tolist()
                        out["score"] += scores.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return cell


def survivors(low: np.ndarray, high: np.ndarray, least: float, most: float, k: int) -> np.ndarray:
    """Which rows may be among the best ``k`` of those that score from ``least`` to ``most``."""
    may = (high >= least) & (low <= most)
    surely = low[(low >= least) & (high <= most)]
    return np.flatnonzero(may & (high >= _least_of_best(surely, k)))


def _negatives_of_cell(k: int, least: int, most: int):
    def cell(held: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"akey": [], "pid": [], "pscore": [], "id": [], "score": []}
        if len(held) and len(asked):
            rows = _Held(held)
            anchors = _matrix(asked.column("ints"), rows.dim).astype(np.int64)
            keys, ids, labels = (asked.column(c).to_numpy() for c in ("akey", "id", "label"))
            positives = asked.column("positives").to_pylist()
            for start in range(0, len(anchors), _AT_ONCE):
                some = slice(start, start + _AT_ONCE)
                lower, upper = rows.bounds(anchors[some])
                for i, (low, high) in enumerate(zip(lower, upper), start):
                    other = np.flatnonzero((rows.labels != labels[i]) & (rows.ids != ids[i]))
                    low, high = low[other], high[other]
                    wanted = [survivors(low, high, least * p["score"] / 100 - 1e-6, most * p["score"] / 100 + 1e-6, k) for p in positives[i]]
                    near = other[np.unique(np.concatenate(wanted))]
                    scores = rows.ints[near] @ anchors[i]
                    for p in positives[i]:
                        fits = (100 * scores >= least * p["score"]) & (100 * scores <= most * p["score"])
                        found, of = rows.best(near[fits], scores[fits], k)
                        n = len(found)
                        for c, v in (("akey", [keys[i]] * n), ("pid", [p["id"]] * n), ("pscore", [p["score"]] * n), ("id", found.tolist()), ("score", of.tolist())):
                            out[c] += v
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return cell


def mine(rows: DataFrame, anchors: Column, scratch: Scratch, positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` as ``integer_rows`` gives them; ``anchors`` says which of them are asked for.
    ``band``: percent of the positive's score that a negative's score lies between.
    """
    stored = scratch.keep(index(rows), "codes")
    asked = scratch.keep(stored.filter(F.coalesce(anchors, F.lit(False))).select("id", "label", "dim", "ints").distinct()
                         .withColumn("akey", F.xxhash64("id", "label", "ints")), "anchors")
    tiles, blocks = (max(1, -(-df.count() // n)) for df, n in ((stored, TILE_ROWS), (asked, BLOCK_ROWS)))
    left, right = _cells(tiles, blocks)
    grid = lambda q: left(stored).groupBy("tile", "block", "dim").cogroup(right(q).groupBy("tile", "block", "dim"))

    near = grid(asked).applyInArrow(_positives_of_cell(positives), "akey bigint, id bigint, score bigint")
    near = top_per_group(near, ["akey"], [F.desc("score"), F.asc("id")], positives)
    found = near.groupBy("akey").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    paired = scratch.keep(asked.join(found, "akey"), "positives")

    far = grid(paired).applyInArrow(_negatives_of_cell(negatives, *band), "akey bigint, pid bigint, pscore bigint, id bigint, score bigint")
    far = top_per_group(far, ["akey", "pid", "pscore"], [F.desc("score"), F.asc("id")], negatives)
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return far.join(paired.select("akey", F.col("id").alias("anchor_id")), "akey").select(
        "anchor_id", known("pid").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("id").alias("negative_id"),
        F.col("pscore").alias("positive_score"), F.col("score").alias("negative_score"))


@query("op13_hard_negatives", """
WITH rows AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (SELECT a.id AS a, r.id AS r, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM rows a, rows r WHERE a.id % 100 = 0 AND a.id <> r.id),
pos AS (SELECT a, r AS p, score AS ps FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, r) AS k FROM pairs WHERE same) WHERE k <= 5),
neg AS (SELECT pos.a, p, ps, r, score, row_number() OVER (PARTITION BY pos.a, p ORDER BY score DESC, r) AS k
  FROM pos JOIN pairs ON pos.a = pairs.a AND NOT same AND 30 * ps <= 100 * score AND 100 * score <= 90 * ps)
SELECT a AS anchor_id, p AS positive_id, k::INTEGER AS rank, r AS negative_id, ps AS positive_score, score AS negative_score FROM neg WHERE k <= 10""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five positives of each hundredth vector, ten negatives for each."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = integer_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", label)
    return mine(rows, F.col("id") % 100 == 0, Scratch(spark))
