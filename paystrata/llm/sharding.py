"""Sharding by vector bin packing: bytes, words and rows balanced together.

Equal texts form a group and go to one shard. Groups are far too many to place one by
one, so the small ones are first dealt by hash into cells, whose number is a parameter;
a group with more than ``1 / PARTS`` of a shard in any dimension is placed apart, cut by
a hash of the ids into parts below that size, so that a hot group spreads. The driver
sees one vector per cell and part - bounded by parameters, whatever the table's size -
and places each, largest first, into the shard where the dot product with what is left
of its capacity is highest. Law: ``bytes``.

A null text has no bytes and counts as empty. Repeated rows are rows of one group. An
empty table gives no rows. A single text larger than a shard cannot be cut.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, documents
from paystrata.llm.registry import query

SHARDS = 24
CELLS_PER_SHARD = 256
#: A group above this part of a shard is placed apart and cut.
PARTS = 2
#: Rows numbered together in one task.
SLOT_ROWS = 100_000
WORD = "[^\\x20\\x09-\\x0D]+"


def measured(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """The narrow row of each document: size, checksum, words, and a hash of its text as its group."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        F.xxhash64(text).alias("group"), *(["text"] if keep_text else []))


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector: largest first, to the highest dot product with the residual capacity."""
    total = vectors.sum(0)
    share = vectors / np.where(total > 0, total, 1) * shards  # a shard's capacity is 1 in every dimension
    left = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(share)), -share.max(1))):
        best = int(np.argmax(left @ share[i]))
        left[best] -= share[i]
        out[i] = best
    return out


def number(rows: DataFrame, by: str, order: list[str], total: int) -> DataFrame:
    """``slot``: gapless from 0 in each value of ``by``; rows are numbered in blocks, so no task holds a whole shard."""
    blocks = max(1, -(-total // SLOT_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    sizes = rows.groupBy(by, "block").agg(F.count("*").alias("n"))
    before = sizes.select(by, "block", F.coalesce(F.sum("n").over(
        W.partitionBy(by).orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = rows.withColumn("inside", F.row_number().over(W.partitionBy(by, "block").orderBy(*order)) - 1)
    return inside.join(before, [by, "block"]).withColumn("slot", (F.col("before") + F.col("inside")).cast("bigint"))


def plan(rows: DataFrame, shards: int, total) -> tuple[DataFrame, DataFrame]:
    """The parts of hot groups and the shard of each cell, two small tables bounded by ``shards``."""
    spark = rows.sparkSession
    limits = [max(1.0, x / (shards * PARTS)) for x in (total.b, max(total.w, 1), total.n)]
    groups = rows.groupBy("group").agg(F.sum("size").alias("b"), F.sum("words").alias("w"), F.count("*").alias("n"))
    parts = F.ceil(F.greatest(*(F.col(c) / m for c, m in zip("bwn", limits))))
    # At most shards * PARTS groups can exceed the limit in each dimension.
    hot = groups.filter((parts > 1) & (F.col("n") > 1)).select("group", F.least(parts, F.col("n")).cast("int").alias("parts")).collect()
    names = spark.createDataFrame([(r.group, r.parts) for r in hot], "group bigint, parts int")
    vectors = (celled(rows, names, shards).groupBy("cell").agg(F.sum("size").alias("b"), F.sum("words").alias("w"), F.count("*").alias("n"))
               .orderBy("cell").collect())
    at = place(np.array([[r.b, r.w, r.n] for r in vectors], dtype=np.float64), shards)
    return names, spark.createDataFrame([(r.cell, int(s)) for r, s in zip(vectors, at)], "cell string, shard int")


def celled(rows: DataFrame, names: DataFrame, shards: int) -> DataFrame:
    own = F.concat(F.lit("c"), F.pmod(F.xxhash64("group", F.lit(1)), F.lit(shards * CELLS_PER_SHARD)).cast("string"))
    part = F.concat_ws("/", F.col("group").cast("string"), F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("string"))
    return rows.join(F.broadcast(names), "group", "left").withColumn("cell", F.when(F.col("parts").isNull(), own).otherwise(part))


def totals(rows: DataFrame):
    return rows.agg(F.sum("size").alias("b"), F.sum("words").alias("w"), F.count("*").alias("n")).first()


def assign(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of each row of ``measured``; read several times, so pass a written table."""
    out = ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")]
    total = totals(rows)
    if not total.n:
        return rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("bigint")).select(*out)
    names, placed = plan(rows, shards, total)
    rows = celled(rows, names, shards).join(F.broadcast(placed), "cell").select("doc_id", "size", "text_crc32", "shard")
    return number(rows, "shard", ["doc_id", "text_crc32", "size"], total.n).select(*out)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents themselves in ``shard=`` folders, each in files of ascending doc_id."""
    rows, keep = Scratch(docs.sparkSession).keep(measured(docs), "shards"), ["doc_id", "text"]
    total = totals(rows)
    if not total.n:
        return docs.select(*keep, F.lit(0).alias("shard")).write.partitionBy("shard").parquet(path)
    names, placed = plan(rows, shards, total)
    texts = celled(measured(docs, keep_text=True), names, shards).join(F.broadcast(placed), "cell").select(*keep, "shard")
    files = max(shards, int(total.b) >> 27)
    texts.repartitionByRange(files, "shard", "doc_id").sortWithinPartitions("shard", "doc_id").write.partitionBy("shard").parquet(path)


@query("op6_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    return assign(Scratch(spark).keep(measured(documents(spark, sf_dir)), "sizes"))
