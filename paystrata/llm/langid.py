"""Language identification by nearest centroid.

A text is lower-cased, everything in it but letters becomes space, and its byte trigrams
(none with a space in the middle) are hashed into ``BUCKETS``; the vector is
sqrt(count) * idf, normalised. Each language gets ``CLUSTERS`` centroids from spherical
k-means over a bounded sample of its labelled documents: ``SAMPLE`` a language, the
documented bound, taken by lowest hash. A text goes to the language of the centroid with
the highest cosine; ``score`` is that cosine. A text is rejected when it has no letter
or when its cosine is below ``REJECT`` times the sample's first percentile among texts of
about its length; without labelled documents, only when it has no letter.

A text that is null or has no letter is ``und`` with score 0, as is every text when there
is no labelled document. Equal cosines go to the first language in order of name.
Repeated rows are predicted each time; the result of a row depends on its text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paystrata.llm.common import column, crc_of_id, documents, steps, text_bytes
from paystrata.llm.registry import query

BUCKETS = 1 << 13
SAMPLE = 1000
CLUSTERS = 4
REJECT = 0.5
UNKNOWN = "und"
#: Texts multiplied with the centroids at a time.
ROWS = 256
_KEEP = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def trigram_counts(texts: list[bytes]) -> np.ndarray:
    """Rows of bucket counts."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for i, text in enumerate(texts):
        a = np.frombuffer(b" " + text.translate(_KEEP) + b" ", dtype=np.uint8).astype(np.uint32)
        code = ((a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA77)) ^ (a[2:] * np.uint32(0xC2B2AE3D)))
        out[i] = np.bincount(((code ^ (code >> np.uint32(15))) >> np.uint32(3) & np.uint32(BUCKETS - 1))[a[1:-1] != 32], minlength=BUCKETS)
    return out


def size_class(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts.sum(1), 1))).astype(np.int64)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts) * idf
    return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)


def centroids(v: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; the first centroids are the mean and then, each time, the vector farthest from all so far."""
    found = [v.mean(0)]
    for _ in range(min(k, len(v)) - 1):
        unit = np.array([c / max(np.linalg.norm(c), 1e-12) for c in found])
        found.append(v[int(np.argmin((v @ unit.T).max(1)))])
    c = np.array(found)
    for _ in range(rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        best = (v @ c.T).argmax(1)
        c = np.array([v[best == j].mean(0) if (best == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def dense(sparse: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(sparse), BUCKETS), dtype=np.float32)
    for row, (at, n) in zip(out, sparse):
        row[at] = n
    return out


class Model:
    """Centroids of all languages, weights of the buckets, and the lowest cosine accepted in each size class.

    ``samples``: for each language the (buckets, counts) of its texts; one language at a time is made dense.
    """

    def __init__(self, samples: dict[str, list[tuple[np.ndarray, np.ndarray]]]):
        self.languages = sorted(samples)
        every = [x for name in self.languages for x in samples[name]]
        found = np.zeros(BUCKETS)
        for at, _ in every:
            found[at] += 1
        self.idf = (np.log((1 + len(every)) / (1 + found)) + 1).astype(np.float32)
        groups = [centroids(vectors(dense(samples[x]), self.idf), CLUSTERS) for x in self.languages]
        self.first = np.cumsum([0, *(len(g) for g in groups)])[:-1]
        self.centroids = np.concatenate(groups).astype(np.float32) if groups else np.zeros((0, BUCKETS), dtype=np.float32)
        self.lowest, size, score = np.zeros(64), [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
        for at in range(0, len(every), ROWS):
            counts = dense(every[at:at + ROWS])
            size.append(size_class(counts))
            score.append(self.nearest(counts)[1])
        size, score, bound = np.concatenate(size), np.concatenate(score), 0.0
        for b in range(64):
            own = score[size == b]
            bound = REJECT * float(np.quantile(own, 0.01)) if len(own) >= 20 else bound
            self.lowest[b] = bound

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosine = np.maximum.reduceat(vectors(counts, self.idf) @ self.centroids.T, self.first, axis=1)
        best = cosine.argmax(1)
        return best, np.clip(cosine[np.arange(len(best)), best], 0, 1)


def lowered(batch: pa.RecordBatch) -> list[bytes]:
    texts = pc.utf8_lower(column(batch, "text").cast(pa.string()))
    return text_bytes(pa.RecordBatch.from_arrays([texts], names=["text"]))


def has_letter(text: bytes) -> bool:
    return text.translate(_KEEP, bytes(range(128, 256))).strip() != b"" or any(map(str.isalpha, text.decode()))


def fit(docs: DataFrame, learn: Column) -> Model:
    """Model of the rows where ``learn`` holds; a bounded number of them is read."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # The sample's bound in each language, as a hash that its documents do not exceed: one row a language.
    place = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    hashes = rows.select("lang", F.xxhash64("doc_id").alias("h")).distinct().withColumn("k", place).filter(F.col("k") <= SAMPLE)
    bounds = hashes.groupBy("lang").agg(F.max("h").alias("h")).orderBy("lang").collect()
    if not bounds:
        return Model({})
    bound = F.element_at(F.create_map(*(F.lit(x) for r in bounds for x in (r.lang, r.h))), F.col("lang"))
    chosen = rows.filter(F.xxhash64("doc_id") <= bound).select("doc_id", "lang", "text").dropDuplicates()

    def run(batches):
        for batch in steps(batches):
            texts, langs = lowered(batch), column(batch, "lang").to_pylist()
            pick = [i for i, t in enumerate(texts) if has_letter(t)]
            for i in pick:
                c = trigram_counts([texts[i]])[0]
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([langs[i]]), column(batch, "doc_id").slice(i, 1), pa.array([at.astype("<i2").tobytes()], pa.binary()),
                                                  pa.array([c[at].astype("<f4").tobytes()], pa.binary())], names=["lang", "doc_id", "at", "n"])

    samples: dict[str, list] = {}
    sparse = chosen.mapInArrow(run, "lang string, doc_id bigint, at binary, n binary").collect()  # at most SAMPLE rows a language
    for r in sorted(sparse, key=lambda r: (r.lang, r.doc_id is not None, r.doc_id, r.at, r.n)):
        samples.setdefault(r.lang, []).append((np.frombuffer(r.at, "<i2"), np.frombuffer(r.n, "<f4")))
    return Model(samples)


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row with ``lang_pred``, ``score`` and ``rejected``."""
    def run(batches):
        for batch in steps(batches):
            texts = lowered(batch)
            names, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            known = [i for i, t in enumerate(texts) if has_letter(t)]
            if not model.languages:
                rejected[known], known = False, []
            for at in range(0, len(known), ROWS):
                rows = known[at:at + ROWS]
                counts = trigram_counts([texts[i] for i in rows])
                best, score = model.nearest(counts)
                low = score < model.lowest[np.minimum(size_class(counts), 63)]
                for i, b, s, x in zip(rows, best.tolist(), score.tolist(), low.tolist()):
                    names[i], scores[i], rejected[i] = model.languages[b], s, x
            yield pa.RecordBatch.from_arrays([*(column(batch, k) for k in keep), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                                             names=[*keep, "lang_pred", "score", "rejected"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "lang_pred string, score double, rejected boolean"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def table(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string"))


@query("op4_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from the rows outside the held-out fold."""
    docs, fold = table(documents(spark, sf_dir)), crc_of_id("doc_id") % 4
    model = fit(docs, fold != 2)
    return identify(docs, model, ["doc_id"]).select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score", "rejected")
