"""Packing token ids into sequences of a fixed window by non-negative least squares.

Each document is cut into whole windows and one remainder. The remainders' lengths, in
classes of ``UNIT`` ids, form a histogram (one row per class reaches the driver). All
combinations of at most ``DEPTH`` classes that fill a window are enumerated, and how
often to repeat each follows from a non-negative least squares fit to the histogram.
Every task packs its own documents by that mix: it rounds the repeat counts down to what
it holds, and packs what is left greedily, first into the gaps of the combinations, then
end to end, cutting where a sequence is full. The tail of a task's block goes into
sequences of a power of two, which need no padding, so nothing is padded at all.

Nothing is shuffled but the histogram. Null and empty texts are their end id alone;
repeated rows are packed each time; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, column, documents
from paystrata.llm.registry import query
from paystrata.llm.tokens import token_table, unpack_ids

WINDOW = 4096
UNIT = 64
DEPTH = 4
#: Share of the remainders held back from the combinations to fill their gaps.
RESERVE = 0.06
#: Ids packed together in a task; bounds its memory.
BLOCK_IDS = 16_000_000
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, sequence_tokens bigint")


def combinations(classes: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Class combinations, largest first, that add up to ``classes``."""
    out = [(classes,)]
    for k in range(1, depth):
        for small in combinations_with_replacement(range(1, classes // 2 + 1), k):
            rest = classes - sum(small)
            if rest >= small[-1]:
                out.append((rest, *reversed(small)))
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with the least ``|a x - b|``, by active sets."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(np.argmax(gain)) if len(gain) else 0
        if not len(gain) or gain[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            want = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (want > 0).all():
                x[:] = 0
                x[at] = want
                break
            low = want <= 0
            share = np.min(x[at][low] / np.maximum(x[at][low] - want[low], 1e-300))
            x[at] += share * (want - x[at])
            drop = at[(x[at] <= 1e-12) & low]
            x[drop] = 0
            free[drop] = False
            if not len(drop) or not free.any():
                break
    return x


def fit_mix(histogram: dict[int, int], window: int = WINDOW, unit: int = UNIT) -> list[tuple[tuple[int, ...], float]]:
    """(combination, repeats per remainder), most often first, from the remainders' class counts."""
    classes, total = -(-window // unit), sum(histogram.values())
    if not total:
        return []
    combos = combinations(classes)
    a = np.zeros((classes, len(combos)))
    for j, combo in enumerate(combos):
        for c, n in Counter(combo).items():
            a[c - 1, j] = n
    b = np.array([histogram.get(c, 0) / total for c in range(1, classes + 1)])
    weight = np.arange(1, classes + 1) / classes  # short remainders find a place anywhere
    x = nnls(a * weight[:, None], b * weight)
    order = np.argsort(-x, kind="stable")
    return [(combos[j], float(x[j])) for j in order if x[j] > 0]


def pack(lengths: list[int], mix, window: int = WINDOW, unit: int = UNIT) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length); all are full but the last few, whose sizes are powers of two."""
    done, planned, by_class, total = [], [], defaultdict(list), 0
    for d, n in enumerate(lengths):
        whole = n // window
        done += [[(d, k * window, window)] for k in range(whole)]
        if n % window:
            by_class[-(-(n % window) // unit)].append((d, whole * window, n % window))
            total += 1
    for combo, share in mix:
        need = Counter(combo)
        times = min(int(share * total * (1 - RESERVE)), min(len(by_class[c]) // n for c, n in need.items()))
        planned += [[by_class[c].pop() for c in combo] for _ in range(times)]
    rest = sorted((p for ps in by_class.values() for p in ps), key=lambda p: (p[2], p))
    held = sum(p[2] for p in rest)

    def take(n: int) -> list[tuple[int, int, int]]:
        got = []
        while n:
            d, start, length = rest.pop()
            use = min(n, length)
            got.append((d, start, use))
            if use < length:
                rest.append((d, start + use, length - use))
            n -= use
        return got

    for sequence in planned:
        gap = window - sum(p[2] for p in sequence)
        if gap > held:  # nothing is left to fill it: its pieces join the rest
            rest += sequence
            held += window - gap
        else:
            done.append(sequence + take(gap))
            held -= gap
    while held >= window:
        done.append(take(window))
        held -= window
    while held:
        size = 1 << (held.bit_length() - 1)
        done.append(take(size))
        held -= size
    return done


def pack_documents(tokens: DataFrame, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """One row per piece of a token table's documents."""
    left = F.col("n_ids") % window
    rows = tokens.filter(left > 0).groupBy(F.ceil(left / unit).cast("int").alias("c")).agg(F.count("*").alias("n")).collect()
    mix = fit_mix({r.c: r.n for r in rows}, window, unit)

    def run(batches):
        first = TaskContext.get().partitionId() << 40
        held, names, sizes, total = [], [], [], 0

        def close():
            nonlocal first
            raw = [memoryview(unpack_ids(p, n).astype("<u4").tobytes()) for p, n in zip(held, sizes)]
            out = []
            for pieces in pack(sizes, mix, window, unit):
                offset, whole = 0, sum(p[2] for p in pieces)
                for d, start, length in pieces:
                    out.append((names[d], start, length, zlib.crc32(raw[d][4 * start:4 * (start + length)]), sizes[d], first, offset, whole))
                    offset += length
                first += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=[c.split()[0] for c in PIECES.split(", ")])

        for batch in batches:
            for name, n, packed in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "n_ids", "ids"))):
                if held and total + n > BLOCK_IDS:
                    yield close()
                    held, names, sizes, total = [], [], [], 0
                held.append(packed)
                names.append(name)
                sizes.append(n)
                total += n
        if held:
            yield close()

    return tokens.mapInArrow(run, PIECES)


@query("op7_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 ids."""
    return pack_documents(Scratch(spark).keep(token_table(documents(spark, sf_dir)), "tokens"))
