"""MinHash near-duplicates by a multi-index Hamming join.

A document's set of word shingles is signed with ``SYMBOLS`` minima, of which ``b`` = 16
bits are kept. The first ``INDEXED`` are cut into ``CHUNKS`` chunks; if two of these differ in at
most ``2 * CHUNKS - 1`` symbols, some chunk holds at most one error (pigeonhole), so each
chunk is indexed once for each symbol left out, and every pair under that distance meets
in a bucket. At a similarity of 0.8 two documents miss all buckets with a probability of
1e-7, less above. Candidates are checked by signature distance and confirmed on the full
shingle sets.

Equal sets are one node from the start. Buckets are never expanded into all pairs while
they hold one component: each member first meets its best bucket centre, links become
components, and only pairs across different components are looked at again. Before that,
members of such buckets are weighed by their shingles that no other of them has: a set
of which more than a fifth is its own can have no link, and leaves. Of the rest all pairs
across components meet in buckets of up to ``SMALL`` members; larger ones meet further
centres for ``ROUNDS`` rounds, those with the fewest shingles of their own first, and what
is then still apart is joined on the shingles that a link could not do without, rarest
first - the exact way for the rest. So every link counts, whether or not it is listed.

Null or empty texts and texts without words have an empty set and no links. A row with a
null doc_id has no name a component could carry: it is returned alone. Repeated rows are
equal sets; a doc_id with several texts has a component for each row's text: sets are told apart by their
hashes, and a component takes the least doc_id of its rows as its name. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paystrata.llm.common import LOWER, Scratch, column, documents, mix, shingles, steps, text_bytes
from paystrata.llm.components import components
from paystrata.llm.registry import query

CHUNKS, PER_CHUNK = 12, 5
#: Symbols in the index, and in the whole signature, by which candidates are checked.
INDEXED, SYMBOLS = CHUNKS * PER_CHUNK, 128
#: Symbols two signatures must share to be confirmed; five standard deviations below 0.8.
AGREE = 80
SMALL, ROUNDS = 48, 2
PERCENT = 80
_U = np.uint64
MULTIPLY = mix(np.arange(1, SYMBOLS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
ADD = mix(np.arange(1, SYMBOLS + 1, dtype=_U) * _U(0xD6E8FEB86659FD93))


def distinct_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the bounds of each text's."""
    hashes, of, _ = shingles(texts, width, LOWER, short=True)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def set_hashes(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set; those of empty sets are zero."""
    full = np.flatnonzero(np.diff(bounds))
    sets = np.zeros((2, len(bounds) - 1), dtype=_U)
    if len(full):
        for k in range(2):
            sets[k, full] = np.add.reduceat(mix(hashes + _U(k + 1)), bounds[full])
    return sets[0].view(np.int64), sets[1].view(np.int64)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signature symbols and two hashes of each set; rows of empty sets are zero."""
    full = np.flatnonzero(np.diff(bounds))
    signs = np.zeros((len(bounds) - 1, SYMBOLS), dtype="<u2")
    if len(full):
        at = bounds[full]
        for j in range(SYMBOLS):
            signs[full, j] = (mix(np.minimum.reduceat(hashes * MULTIPLY[j] + ADD[j], at)) & _U(0xFFFF)).astype("<u2")
    return signs, *set_hashes(hashes, bounds)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in steps(batches):
            hashes, bounds = distinct_sets(text_bytes(batch), width)
            signs, a, b = signatures(hashes, bounds)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(np.diff(bounds)), pa.array(a), pa.array(b),
                                              pa.array([s.tobytes() for s in signs], pa.binary())], names=["doc_id", "n_shingles", "h1", "h2", "sign"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, sign binary")


def bucket_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): each chunk with each of its symbols left out."""
    def run(batches):
        for batch in batches:
            signs = np.frombuffer(b"".join(column(batch, "sign").to_pylist()), dtype="<u2").reshape(-1, SYMBOLS)[:, :INDEXED]
            signs = signs.reshape(-1, CHUNKS, PER_CHUNK).astype(_U)
            node = column(batch, "node").to_numpy(zero_copy_only=False)
            for out in range(PER_CHUNK):
                rest = [p for p in range(PER_CHUNK) if p != out]
                key = np.zeros(signs.shape[:2], dtype=_U)
                for p in rest:
                    key = (key << _U(16)) | signs[:, :, p]
                key = mix(key ^ mix(np.arange(CHUNKS, dtype=_U) * _U(PER_CHUNK) + _U(out + 1)))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).reshape(-1)), pa.array(np.repeat(node, CHUNKS))], names=["key", "node"])
    return nodes.select("node", "sign").mapInArrow(run, "key bigint, node bigint")


def agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures share ``AGREE`` symbols or more, and how many."""
    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(column(batch, c).to_pylist()), dtype="<u2").reshape(-1, SYMBOLS) for c in ("sa", "sb"))
            same = (a == b).sum(1)
            keep = same >= AGREE
            yield pa.RecordBatch.from_arrays([column(batch, "a").filter(pa.array(keep)), column(batch, "b").filter(pa.array(keep)),
                                              pa.array(same[keep].astype(np.int32))], names=["a", "b", "same"])

    side = lambda x: nodes.select(F.col("node").alias(x), F.col("sign").alias(f"s{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint, same int")


def packed_texts(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in steps(batches):
            texts = text_bytes(batch)
            a, b = set_hashes(*distinct_sets(texts, width))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(a), pa.array(b), pa.array([pack(t) for t in texts], pa.binary())],
                                             names=["label", "h1", "h2", "packed"])
    packed = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(run, "label bigint, h1 bigint, h2 bigint, packed binary")
    return packed.select("label", F.xxhash64("h1", "h2").alias("node"), "packed")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                both = [unpack(x) for c in ("pa", "pb") for x in column(part, c).to_pylist()]
                hashes, bounds = distinct_sets(both, width)
                n, keep = part.num_rows, []
                for i in range(n):
                    x, y = hashes[bounds[i]:bounds[i + 1]], hashes[bounds[n + i]:bounds[n + i + 1]]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield pa.RecordBatch.from_arrays([column(part, c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    side = lambda x: texts.select(F.col("node").alias(x), F.col("packed").alias(f"p{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "pa", "pb").mapInArrow(run, "a bigint, b bigint")


class Linker:
    """The growing links, components and tested pairs of one run."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, scratch: Scratch, width: int, percent: int):
        self.scratch, self.nodes, self.width, self.percent = scratch, nodes, width, percent
        keys = bucket_keys(nodes)
        shared = scratch.keep(keys.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).filter("n > 1"), "buckets")
        self.members = scratch.keep(keys.join(shared, "key"), "members")
        scratch.drop(shared)
        some = nodes.select("node", "label").join(self.members.select("node").distinct(), "node", "left_semi")
        texts = packed_texts(docs, width).join(some, ["node", "label"], "left_semi").dropDuplicates(["node", "label"])
        self.texts = scratch.keep(texts.select("node", "packed"), "texts")
        self.labels = self.links = self.tested = None

    def label(self, side: str) -> DataFrame:
        return self.labels.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs of different components that were not tested yet."""
        if self.labels is None:
            return pairs
        own = lambda x: F.coalesce(F.col(f"c{x}"), F.col(x))
        pairs = pairs.join(self.label("a"), "a", "left").join(self.label("b"), "b", "left").filter(own("a") != own("b")).select("a", "b")
        return pairs.join(self.tested, ["a", "b"], "left_anti")

    def test(self, pairs: DataFrame, best: bool = False) -> None:
        """Confirm the pairs and renew the components; ``best``: each b with its closest a alone."""
        ordered = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = agreeing(self.apart(ordered), self.nodes)
        if best:
            found = (found.groupBy("b").agg(F.max(F.struct("same", (-F.col("a")).alias("a"))).alias("m"))
                     .select((-F.col("m.a")).alias("a"), "b"))
        found = self.scratch.keep(found.select("a", "b"), "pairs")
        links = self.scratch.keep(confirmed(found, self.texts, self.width, self.percent), "links")
        self.tested = found if self.tested is None else self.tested.unionAll(found)
        if self.labels is not None and links.isEmpty():
            return
        self.links = links if self.links is None else self.links.unionAll(links)
        if self.labels is not None:
            self.scratch.drop(self.labels)
        self.labels = components(self.links, self.scratch)

    def split(self, members: DataFrame) -> DataFrame:
        """Members of buckets that hold more than one component, with the bucket's size."""
        rows = members.join(self.labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        mixed = (rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n"))
                 .filter("low <> high").select("key", "n"))
        return self.scratch.keep(rows.join(mixed, "key"), "split")

    def shingles_of(self, some: DataFrame) -> DataFrame:
        """(h, node, size): the distinct shingles of the nodes."""
        width = self.width

        def run(batches):
            unpack = zstandard.ZstdDecompressor().decompress
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    hashes, bounds = distinct_sets([unpack(x) for x in column(part, "packed").to_pylist()], width)
                    size = np.diff(bounds)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(np.repeat(column(part, "node").to_numpy(), size)),
                                                      pa.array(np.repeat(size, size))], names=["h", "node", "size"])
        return self.texts.join(some, "node", "left_semi").mapInArrow(run, "h bigint, node bigint, size bigint")

    def linkable(self, rows: DataFrame) -> DataFrame:
        """(node, own): nodes whose shingles in common with others can make up the similarity, and how many are their own."""
        sets = self.scratch.keep(self.shingles_of(rows.select("node").distinct()), "shingles")
        alone = sets.groupBy("h").agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1")
        sizes = sets.groupBy("node").agg(F.first("size").alias("size"))
        own = F.coalesce("own", F.lit(0))
        out = (sizes.join(alone.groupBy("node").agg(F.count("*").alias("own")), "node", "left").filter(100 * (F.col("size") - own) >= self.percent * F.col("size"))
               .select("node", own.alias("own")))
        out = self.scratch.keep(out, "linkable")
        self.scratch.drop(sets)
        return out

    def rest(self, large: DataFrame) -> DataFrame:
        """Pairs (a, b) across components that could be links: sharing one of the shingles a link cannot do without.

        In one order of all shingles, rarest first, two sets that share at least m shingles meet within the first
        ``size - m + 1`` of each.
        """
        sets = self.shingles_of(large.select("node").distinct())
        rare = sets.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
        place = F.row_number().over(W.partitionBy("node").orderBy(F.coalesce("n", F.lit(1)), "h"))
        ranked = sets.join(rare, "h", "left").withColumn("k", place).filter("n > 1 AND k <= size - ceil(size * {0} / 100) + 1".format(self.percent))
        ranked = self.scratch.keep(ranked.join(self.labels, "node", "left").select("h", "node", "size", "k", F.coalesce("comp", "node").alias("comp")), "ranked")
        sizes = large.groupBy("key", "comp").agg(F.count("*").alias("m"))
        most = sizes.groupBy("key").agg(F.max_by("comp", F.struct("m", "comp")).alias("most"))
        apart = large.join(most, "key").filter("comp <> most").select("node").distinct()
        x, y = ranked.join(apart, "node", "left_semi").alias("x"), ranked.alias("y")
        need = F.ceil(F.lit(self.percent) * (F.col("x.size") + F.col("y.size")) / (100 + self.percent))
        meet = ((F.col("x.h") == F.col("y.h")) & (F.col("x.comp") != F.col("y.comp")) & (F.col("x.k") <= F.col("x.size") - need + 1)
                & (F.col("y.k") <= F.col("y.size") - need + 1))
        return x.join(y, meet).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    def run(self) -> DataFrame:
        self.test(self.members.select(F.col("centre").alias("a"), F.col("node").alias("b")), best=True)
        rows = self.split(self.members.select("key", "node"))
        if rows.isEmpty():
            return self.labels
        weighed = self.linkable(rows)
        members = self.scratch.keep(rows.select("key", "node").join(weighed, "node").select("key", "node", "own"), "members")
        self.scratch.drop(rows)
        rows = self.split(members)
        small = rows.filter(F.col("n") <= SMALL)
        pairs = (small.alias("x").join(small.alias("y"), "key").filter("x.node < y.node and x.comp <> y.comp")
                 .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
        for k in range(ROUNDS + 1):
            large = rows.filter(F.col("n") > SMALL)
            if large.isEmpty():
                if k == 0:
                    self.test(pairs)
                break
            if k == ROUNDS:
                self.test(self.rest(large) if k else pairs.unionAll(self.rest(large)))
                break
            first = F.struct("own", F.xxhash64("node")) if k == 0 else F.struct(F.xxhash64("node", F.lit(k)), "own")
            centre = large.groupBy("key").agg(F.min_by(F.struct("node", "comp"), first).alias("c"))
            centre = centre.select("key", F.col("c.node").alias("a"), F.col("c.comp").alias("ca"))
            met = large.join(centre, "key").filter("comp <> ca").select("a", F.col("node").alias("b"))
            self.test(met if k else pairs.unionAll(met))
            self.scratch.drop(rows)
            rows = self.split(members)
        return self.labels


def near_duplicates(docs: DataFrame, width: int, percent: int = PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; ``docs`` has doc_id and text."""
    scratch = scratch or Scratch(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    rows = scratch.keep(sketches(docs, width), "sketches")
    named = rows.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes = scratch.keep(named.groupBy("h1", "h2").agg(F.min("doc_id").alias("label"), F.first("sign").alias("sign"))
                         .withColumn("node", F.xxhash64("h1", "h2")), "nodes")
    linker = Linker(docs, nodes, scratch, width, percent)
    labels = linker.run()
    linked = nodes.join(labels, "node").select("node", "comp", "label")
    names = linked.groupBy("comp").agg(F.min("label").alias("name"))
    named = linked.join(names, "comp").select("node", "name")
    of = nodes.join(named, "node", "left").select("h1", "h2", F.coalesce("name", "label").alias("comp"))
    out = rows.join(of, ["h1", "h2"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("comp")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, width: int, scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` but one of each group of near copies: the one that gave the group its name.

    Where ids are repeated or null each row is judged by itself, null ids last; of repeated rows one stays.
    """
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL").isEmpty():
        judged = scratch.keep(near_duplicates(docs, width, percent, scratch).select("doc_id", "kept"), "judged")
        return docs.join(judged.filter(~F.col("kept")).select("doc_id"), "doc_id", "left_anti")
    rows = scratch.keep(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    judged = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), width, percent, scratch)
    judged = judged.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row")
    first = judged.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "__row")).alias("m"))
    first = scratch.keep(first.select(F.col("m.__row").alias("__row")), "judged")
    return rows.join(first, "__row", "left_semi").dropDuplicates(["doc_id", "text"]).drop("__row")


SQL = """WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i+3], ' ')) END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id JOIN n nx ON nx.doc_id = x.doc_id
    JOIN n ny ON ny.doc_id = y.doc_id GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(nx.n) + any_value(ny.n) - count(*))),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a) SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON a = d.doc_id"""


@query("op5_near_duplicates", SQL)
def near_duplicate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over 4-word shingles."""
    return near_duplicates(documents(spark, sf_dir), width=4)
