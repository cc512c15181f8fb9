"""Token files: canonical length-limited Huffman codes from global counts.

A token file set is two Parquet tables under one folder. ``codebook`` holds one row per
used id with its code length (at most the vocabulary); the codes follow from the lengths.
``blocks`` holds independent blocks of whole documents in ascending ``doc_id`` order:
the documents with their sizes, the bit offset of every ``CHECKPOINT``-th id, and the
bits. A reader needs the codebook and any one block. All lanes between checkpoints are
decoded side by side by table look-up.

Null and empty texts hold the end id alone; an empty table gives files without blocks;
repeated rows are written each time; a null doc_id sorts first. Documents are not cut,
so a block is as large as ``BLOCK_IDS`` or as its one longer document.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, column, documents
from paystrata.llm.registry import query
from paystrata.llm.tokens import ENCODE_BYTES, token_table, unpack_ids
from paystrata.session import scratch_path, settings

MAX_BITS = 18
BLOCK_IDS = 1 << 17
CHECKPOINT = 256
#: Ids a file holds on average; sets how many range partitions are written.
FILE_IDS = 4_000_000
#: Bytes of a batch of texts between Spark and Python.
BATCH_BYTES = ENCODE_BYTES - (1 << 20)
#: Ids counted at a time.
COUNTED_IDS = 1 << 20
BLOCKS = ("file int, block int, n_ids bigint, doc_ids array<bigint>, doc_sizes array<bigint>, "
          "checkpoints array<bigint>, bits binary")


def count_ids(tokens: DataFrame) -> DataFrame:
    """Rows (id, n) over all documents; each task adds up its own ids first."""
    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        held, size = [], 0

        def add():
            # Many texts at a time: counting costs as much as the largest id, however short a text is.
            nonlocal total, held, size
            part = np.bincount(np.concatenate(held)) if held else total[:0]
            if len(part) > len(total):
                total = np.concatenate((total, np.zeros(len(part) - len(total), dtype=np.int64)))
            total[:len(part)] += part
            held, size = [], 0

        for batch in batches:
            for packed, n in zip(column(batch, "ids"), column(batch, "n_ids").to_pylist()):
                held.append(unpack_ids(packed.as_py(), n))
                size += n
                if size >= COUNTED_IDS:
                    add()
        add()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    return tokens.select("n_ids", "ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge; ``counts`` are all positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    merged, flags = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        weights = np.concatenate((leaves, pairs))
        by = np.argsort(weights, kind="stable")
        merged = weights[by]
        flags.append(by < n)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for flag in reversed(flags):
        own = int(flag[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Codes:
    """Canonical codes of a codebook: by length, then by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(lengths.max()) if len(lengths) else 1
        width = np.int64(1) << (self.bits - lengths)
        left = np.cumsum(width) - width
        size = int(ids.max()) + 1 if len(ids) else 1
        self.code, self.length = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        self.code[ids], self.length[ids] = (left >> (self.bits - lengths)).astype(np.uint64), lengths
        self.symbol = np.zeros(1 << self.bits, dtype=np.int32)
        self.step = np.ones(1 << self.bits, dtype=np.int64)
        filled = int(width.sum())
        self.symbol[:filled], self.step[:filled] = np.repeat(ids, width), np.repeat(lengths, width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, as big-endian 32-bit words, and the bit offset of each id."""
        length = self.length[ids]
        at = np.cumsum(length) - length
        if not len(ids):
            return b"", at
        value = self.code[ids] << (64 - (at & 31) - length).astype(np.uint64)
        word = at >> 5  # every word but the last starts a code, as no code has 32 bits
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words = np.zeros(int(word[-1]) + 2, dtype=np.uint64)
        words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        used = (int(at[-1] + length[-1]) + 31) >> 5
        return words[:used].astype(">u4").tobytes(), at

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """Ids of several blocks (bits, checkpoints, number of ids), all lanes at once."""
        parts, lanes, base = [], [], 0
        for bits, checkpoints, _ in blocks:
            lanes.append(np.asarray(checkpoints, dtype=np.int64) + 32 * base)
            parts.append(np.frombuffer(bits, dtype=">u4"))
            base += len(parts[-1])
        words = np.concatenate([*parts, np.zeros(2, dtype=">u4")]).astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at = np.concatenate(lanes) if lanes else np.zeros(0, dtype=np.int64)
        steps = min(CHECKPOINT, max((n for _, _, n in blocks), default=0))
        out = np.zeros((len(at), CHECKPOINT), dtype=np.int32)
        shift, last = np.uint64(64 - self.bits), len(pairs) - 1
        for t in range(steps):
            window = (pairs[np.minimum(at >> 5, last)] << (at & 31).astype(np.uint64)) >> shift
            out[:, t] = self.symbol[window]
            at = at + self.step[window]
        result, row = [], 0
        for _, checkpoints, n in blocks:
            result.append(out[row:row + len(checkpoints)].reshape(-1)[:n])
            row += len(checkpoints)
        return result


def write_token_files(tokens: DataFrame, path: str) -> None:
    """Write a token table as a file set: ``codebook`` and ``blocks`` in ascending doc_id order."""
    spark = tokens.sparkSession
    counted = count_ids(tokens).toPandas()  # at most one row per id of the vocabulary
    ids, counts = counted["id"].to_numpy(), counted["n"].to_numpy()
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, lengths)], "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    files = max(1, math.ceil(int(counts.sum()) / FILE_IDS))

    def run(batches):
        codes, file = Codes(ids, lengths), TaskContext.get().partitionId()
        held, names, sizes, total, block = [], [], [], 0, 0

        def close():
            bits, at = codes.encode(np.concatenate(held))
            return pa.RecordBatch.from_arrays([
                pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([total], pa.int64()),
                pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([at[::CHECKPOINT]], pa.list_(pa.int64())), pa.array([bits], pa.binary())],
                names=["file", "block", "n_ids", "doc_ids", "doc_sizes", "checkpoints", "bits"])

        for batch in batches:
            for name, n, packed in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "n_ids", "ids"))):
                if held and total + n > BLOCK_IDS:
                    yield close()
                    held, names, sizes, total, block = [], [], [], 0, block + 1
                held.append(unpack_ids(packed, n).astype(np.int64))
                names.append(name)
                sizes.append(n)
                total += n
        if held:
            yield close()

    ordered = tokens.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "n_ids", "ids")
    ordered.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of a file set: doc_id, start, n_tokens, ids_crc32 and, if asked for, its ids
    as little-endian unsigned 32-bit integers."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()
    ids, lengths = book["id"].to_numpy(), book["length"].to_numpy()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def run(batches):
        codes = Codes(ids, lengths)
        for batch in batches:
            for at in range(0, batch.num_rows, 8):
                rows = batch.slice(at, 8).to_pylist()
                got = codes.decode([(r["bits"], r["checkpoints"], r["n_ids"]) for r in rows])
                out = {k: [] for k in ("doc_id", "file", "block", "place", "n_tokens", "ids_crc32", "ids")}
                for r, all_ids in zip(rows, got):
                    raw, place = memoryview(all_ids.astype("<u4").tobytes()), 0
                    for name, n in zip(r["doc_ids"], r["doc_sizes"]):
                        part = raw[4 * place:4 * (place + n)]
                        for k, v in (("doc_id", name), ("file", r["file"]), ("block", r["block"]), ("place", place), ("n_tokens", n),
                                     ("ids_crc32", zlib.crc32(part)), ("ids", bytes(part) if with_ids else None)):
                            out[k].append(v)
                        place += n
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    docs = blocks.mapInArrow(run, "doc_id bigint, file int, block int, place bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    # Places before a file and before a block: one row per file, then one per block of a file.
    sizes = blocks.select("file", "block", "n_ids")
    files = (sizes.groupBy("file").agg(F.sum("n_ids").alias("n"))
             .select("file", F.coalesce(F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("file_start")))
    inside = sizes.select("file", "block", F.coalesce(F.sum("n_ids").over(
        W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("block_start"))
    out = (docs.join(inside, ["file", "block"]).join(files, "file")
           .select("doc_id", (F.col("file_start") + F.col("block_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "ids"))
    return out if with_ids else out.drop("ids")


@query("op10_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, size and checksum of every document's ids, read back from the files written."""
    scratch, path = Scratch(spark), scratch_path(spark, "token-files")
    # A batch is encoded in one step: larger ones would lie in both processes beside it.
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        tokens = scratch.keep(token_table(documents(spark, sf_dir)), "tokens")
    write_token_files(tokens, path)
    scratch.drop(tokens)
    return read_token_files(spark, path, with_ids=False)
