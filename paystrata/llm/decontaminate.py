"""Benchmark decontamination: containment search by size-partitioned MinHash.

Items of the benchmark are cut into distinct shingles of ``WIDTH`` words (runs of ASCII
letters, digits and all non-ASCII characters; ASCII letters folded). They are partitioned
by size, each partition up to a power of two. An item's sketch is the bottom of its
shingle hashes, ``floor((1 - THRESHOLD) * upper) + 1`` of them for its partition's upper
bound: a document that contains ``THRESHOLD`` of the item must hold one of the sketch, so
no pair is lost, however long the document is. A document's shingles are tested against
all sketches, documents smaller than an item's share are passed over, and each candidate
is verified on the shingles' words themselves.

The items are a stated query set, walked in blocks of at most ``BLOCK_WORDS`` words; each
block is sent to the tasks, which read all documents against it, and no document moves.
An item of fewer than ``WIDTH`` words names no passage and is not searched; a null or
empty text holds nothing; repeated documents and repeated items each give their rows; an
empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import LETTERS, column, documents, shingles, steps, text_bytes
from paystrata.llm.registry import query

WIDTH = 5
THRESHOLD = 0.8
BLOCK_WORDS = 1_000_000
FOUND = "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint, containment double"


def word_shingles(text: bytes, width: int) -> set[bytes]:
    words = text.translate(LETTERS).split()
    return {b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}


class Sketches:
    """Sketches of a block of items: sorted hashes, the item of each, and a small table that rules most hashes out."""

    BITS = 21

    def __init__(self, items: list[tuple[int, bytes]], width: int, threshold: float):
        self.items, self.width, self.threshold = items, width, threshold
        hashes, of, _ = shingles([t for _, t in items], width, LETTERS, short=False)
        keys, owner, self.sizes = [], [], np.zeros(len(items), dtype=np.int64)
        for i in range(len(items)):
            own = np.unique(hashes[of == i]) if len(hashes) else hashes
            self.sizes[i] = len(own)
            upper = 1 << max(0, int(len(own) - 1).bit_length())  # of the item's size partition
            sketch = own[: int(np.floor((1 - threshold) * upper + 1e-9)) + 1]
            keys.append(sketch)
            owner.append(np.full(len(sketch), i))
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.lexsort((owner, keys))
        self.keys, self.owner = keys[order], owner[order]
        self.maybe = np.zeros(1 << self.BITS, dtype=bool)
        self.maybe[self.keys >> np.uint64(64 - self.BITS)] = True

    def candidates(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(text, item) pairs that share a sketch hash."""
        hashes, of, _ = shingles(texts, self.width, LETTERS, short=False)
        sizes = np.bincount(of, minlength=len(texts))
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - self.BITS)])
        low, high = (np.searchsorted(self.keys, hashes[at], side) for side in ("left", "right"))
        n = high - low
        row = np.repeat(of[at], n)
        item = self.owner[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        big = sizes[row] >= self.threshold * self.sizes[item] - 1e-9
        return np.unique(np.stack([row[big], item[big]], 1), axis=0).tolist()

    def verify(self, texts: list[bytes]):
        own: dict[int, set[bytes]] = {}
        last, held = -1, set()
        for row, item in self.candidates(texts):
            if row != last:
                last, held = row, word_shingles(texts[row], self.width)
            if item not in own:
                own[item] = word_shingles(self.items[item][1], self.width)
            shared = len(own[item] & held)
            if shared >= self.threshold * len(own[item]) - 1e-9:
                yield row, self.items[item][0], len(own[item]), shared


def blocks(items: DataFrame):
    held, words = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        text = (r.text or "").encode()
        n = len(text.translate(LETTERS).split())
        if n < WIDTH:
            continue
        if held and words + n > BLOCK_WORDS:
            yield held
            held, words = [], 0
        held.append((r.item_id, text))
        words += n
    if held:
        yield held


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id) of every document that contains an item, with the shared shingles."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))

    def search(block):
        def run(batches):
            sketches = Sketches(block, width, threshold)
            for batch in steps(batches):
                ids, found = column(batch, "doc_id").to_pylist(), list(sketches.verify(text_bytes(batch)))
                if found:
                    rows = [(ids[row], item, n, shared, shared / n) for row, item, n, shared in found]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if k == 4 else pa.int64()) for k, c in enumerate(zip(*rows))],
                                                     names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"])
        return docs.mapInArrow(run, FOUND)

    found = [search(b) for b in blocks(items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")))]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], FOUND)


def without_leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that contain no item; each block of items is one pass, and no row moves."""
    schema = docs.schema
    for block in blocks(items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))):
        def run(batches, block=block):
            sketches = Sketches(block, width, threshold)
            for batch in steps(batches):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[row for row, *_ in sketches.verify(text_bytes(batch))]] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(run, schema)
    return docs


SQL = rf"""WITH w AS (SELECT {{key}}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM {{table}})
  SELECT DISTINCT {{key}}, unnest(list_transform(range(1, len(words) - {WIDTH - 2}), lambda i: array_to_string(words[i:i+{WIDTH - 1}], ' '))) AS s FROM w"""


@query("op2_decontamination", f"""
WITH d AS ({SQL.format(key='doc_id', table='documents')}), b AS ({SQL.format(key='item_id', table='benchmark')}),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_shingles) AS n_shingles, count(*) AS n_shared, count(*) / any_value(n_shingles) AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= {THRESHOLD} * any_value(n_shingles)""")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, and which."""
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
