"""Helpers the training-data operators share: batches, words, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.session import scratch_path

#: Bytes of text one vectorised step works on; bounds a task's memory whatever a batch holds.
STEP_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions travel by value, so their module's globals are new in every task; what is
    kept here is only a cache of pure results, and each user bounds its size.
    """
    module = sys.modules.setdefault("paystrata_worker_store", types.ModuleType("paystrata_worker_store"))
    return module.__dict__.setdefault(name, {})


def large_store(name: str) -> dict:
    """A ``worker_store`` for caches of many megabytes: a worker keeps those of one name at a time.

    Workers are used again by later stages, which would pay for what an earlier one remembers.
    """
    held = worker_store("large")
    if name not in held:
        held.clear()
        gc.collect()
        give_back(heap=True)
    return held.setdefault(name, {})


def give_back(heap: bool = False) -> None:
    """Free memory that Arrow's pool, and with ``heap`` the C heap, kept for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    if heap:
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text (one longer text is a slice of its own)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum([0 if s is None else s for s in pa.compute.binary_length(column).to_pylist()])
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    array = column(batch, name)
    kind = pa.large_binary() if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else pa.binary()
    return [b"" if x is None else x for x in array.cast(kind).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (finaliser of a multiply-xorshift hash)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drop_table(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Intermediate tables in the shared folder; ``drop`` removes one that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, df: DataFrame) -> None:
        path, _ = self.paths.pop(id(df))
        drop_table(self.spark, path)

    def drop_all(self) -> None:
        for path, df in list(self.paths.values()):
            self.drop(df)


def crc_of_id(doc_id: Column | str) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


class ByteHash:
    """Polynomial prefix hashes modulo 2**64 of a byte buffer, all in array operations.

    ``P[i]`` is the sum of ``(byte + 1) * B**j`` below ``i``; the hash of ``[s, e)`` is
    ``(P[e] - P[s]) * B**-s``, the same wherever the bytes stand.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, data: np.ndarray, base: int = BASE):
        powers, inverses = self._tables(len(data) + 1, base)
        self.inverses = inverses
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self.prefix[1:])

    @staticmethod
    def _tables(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        store = large_store("powers")
        if base not in store or len(store[base][0]) < n:
            size = max(n, STEP_BYTES + (1 << 18))
            store[base] = tuple(np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64), dtype=np.uint64)))
                                for b in (base, pow(base, -1, 1 << 64)))
        return store[base]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverses[start]


def join_texts(texts: list[bytes], fold: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All texts, translated by ``fold`` and each closed by a line break, as one buffer, and where each starts."""
    data = np.frombuffer(b"\n".join([*texts, b""]).translate(fold), dtype=np.uint8)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return data, starts.astype(np.int64)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than ASCII white space (0x20, 0x09 to 0x0D)."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shingles(texts: list[bytes], width: int, fold: bytes, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of ``width`` words, the text of each, and the first word's start.

    ``short``: a text of fewer words, but at least one, gives its whole sequence as one.
    """
    data, starts = join_texts(texts, fold)
    s, e = word_spans(data)
    empty = np.zeros(0, dtype=np.int64)
    if not len(s):
        return empty.astype(np.uint64), empty, empty
    words = mix(ByteHash(data).of(s, e))
    of = np.searchsorted(starts, s, "right") - 1
    counts = np.bincount(of, minlength=len(texts))
    n = len(words) - width + 1
    out, at = np.zeros(0, dtype=np.uint64), empty
    if n > 0:
        total = words[:n].copy()
        for j in range(1, width):
            total = mix(total) + words[j:j + n]
        at = np.flatnonzero(of[:n] == of[width - 1:])
        out = mix(total[at])
    if short:
        few = np.flatnonzero((counts > 0) & (counts < width))
        first = np.cumsum(counts) - counts
        extra = []
        for d in few.tolist():
            total = words[first[d]]
            with np.errstate(over="ignore"):
                for j in range(1, counts[d]):
                    total = mix(np.array([total]))[0] + words[first[d] + j]
            extra.append(total)
        out = np.concatenate((out, mix(np.array(extra, dtype=np.uint64) + np.uint64(1)))) if extra else out
        at = np.concatenate((at, first[few]))
    return out, of[at], s[at]


#: ASCII letters to lower case, everything else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The same, and ASCII characters other than letters and digits to spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
