"""Exact substring deduplication: every byte inside a ``length``-byte string that starts twice.

Spark brings together what can be equal. The ``GRAM`` bytes with the least hash inside a
window are its anchor, so equal windows have equal anchors at equal places; windows that
share an anchor in one text form a segment. Segments with one anchor hash meet: if all of
them are the same string they need no comparison, and distinct ones are compared in groups
of at most ``GROUP``. A larger group (the edge of a passage that very many texts share) is
cut into narrower ranges of windows, keyed by a hash of the bytes those windows have in
common, until its groups are small or its windows are single strings, which counting alone
settles. Counts and extremes are aggregated before anything is shuffled.

Inside a group a sparse suffix array decides: the suffixes at the anchors are sorted by
mergesort; two suffixes are compared through prefix polynomial hashes, whose equality over
halving lengths finds the common extension in logarithmic time; the common prefixes of
neighbours give those of all pairs, and common extensions to the left are found the same
way. What the hashes call equal is verified byte by byte.

Null texts are empty; texts under ``length`` bytes keep everything; repeated rows are
copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import ByteHash, Scratch, column, documents, mix, steps, text_bytes
from paystrata.llm.registry import query

LENGTH = 400
GRAM = 64
GROUP = 64
#: Widths of the ranges of windows that too large groups are cut into, level by level.
WIDTHS = (48, 6, 1)
#: Items compared together in a task.
BLOCK_ITEMS = 4000
SECOND = 0xD6E8FEB86659FD93
_U = np.uint64
SEGMENTS = "doc_id bigint, th bigint, start int, count int, anchor int, key bigint, d1 bigint, d2 bigint"
ITEMS = "key bigint, d1 bigint, d2 bigint, n bigint, anchor int, count int, bytes binary"


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def digests(first: ByteHash, second: ByteHash, start: np.ndarray, end: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each string together with its length and its anchor's place."""
    shape = mix((end - start).astype(_U) * _U(1 << 32) + anchor.astype(_U))
    return mix(first.of(start, end) + shape).view(np.int64), mix(second.of(start, end) ^ shape).view(np.int64)


def segments_of(texts: list[bytes], length: int):
    """For all windows of all texts: text, first window, number of windows, anchor's distance, key and digests."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    long = np.flatnonzero(sizes >= length)
    if not len(long):
        return None
    first, second = ByteHash(data), ByteHash(data, SECOND)
    at = np.arange(len(data) - GRAM + 1)
    gram = mix(first.of(at, at + GRAM))
    best = least((gram >> _U(32) << _U(32)) | at.astype(_U), length - GRAM + 1) & _U(0xFFFFFFFF)
    new = np.zeros(len(best) + 1, dtype=bool)
    new[1:-1] = best[1:] != best[:-1]
    lows, highs = ends[long] - sizes[long], ends[long] - length + 1  # windows of a text: low <= start < high
    new[lows], new[highs] = True, True
    valid = np.zeros(len(best) + 1, dtype=np.int32)
    np.add.at(valid, lows, 1)
    np.add.at(valid, highs, -1)
    inside = np.cumsum(valid) > 0
    edges = np.flatnonzero(new)
    start = edges[inside[edges]]
    stop = edges[np.searchsorted(edges, start, "right")]
    anchor = best[start].astype(np.int64)
    of = np.searchsorted(ends, start, "right")
    d1, d2 = digests(first, second, start, stop - 1 + length, anchor - start)
    return of, start - (ends[of] - sizes[of]), stop - start, anchor - start, gram[anchor].view(np.int64), d1, d2


def segments(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in steps(batches):
            found = segments_of(text_bytes(batch), length)
            if found:
                of, start, count, anchor, key, d1, d2 = found
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id").take(pa.array(of)), column(batch, "th").take(pa.array(of)), *(pa.array(x.astype(np.int32)) for x in (start, count, anchor)),
                     pa.array(key), pa.array(d1), pa.array(d2)], names=[c.split()[0] for c in SEGMENTS.split(", ")])
    return docs.select("doc_id", "th", "text").mapInArrow(run, SEGMENTS)


class Suffixes:
    """Suffixes of a buffer, compared through prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data, self.hash = data, ByteHash(data)

    @staticmethod
    def steps(limit: np.ndarray) -> list[int]:
        """Powers of two, falling, whose sum reaches the largest limit."""
        return [1 << k for k in reversed(range(int(np.max(limit, initial=0)).bit_length()))]

    def right(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at x and y, up to ``limit`` bytes."""
        n = np.zeros(np.broadcast(x, y).shape, dtype=np.int64)
        for step in self.steps(limit):
            fits = n + step <= limit
            s = np.where(fits, step, 0)
            n = n + np.where(fits & (self.hash.of(x + n, x + n + s) == self.hash.of(y + n, y + n + s)), step, 0)
        return n

    def left(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Common suffix of what ends before x and before y."""
        n = np.zeros(np.broadcast(x, y).shape, dtype=np.int64)
        for step in self.steps(limit):
            fits = n + step <= limit
            s = np.where(fits, step, 0)
            n = n + np.where(fits & (self.hash.of(x - n - s, x - n) == self.hash.of(y - n - s, y - n)), step, 0)
        return n

    def less(self, x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray) -> np.ndarray:
        """Whether the suffix at x, of rx bytes, stands before that at y, of ry bytes; padding (negative) stands last."""
        px, py = np.maximum(x, 0), np.maximum(y, 0)
        limit = np.minimum(rx, ry)
        n = self.right(px, py, limit)
        last = len(self.data) - 1
        a, b = self.data[np.minimum(px + n, last)], self.data[np.minimum(py + n, last)]
        order = np.where(n < limit, a < b, rx < ry)
        return np.where(x < 0, False, np.where(y < 0, True, order))

    def sort(self, at: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Order of the suffixes of each row, by bottom-up mergesort; rows have a power of two of suffixes."""
        rows, width = at.shape
        order = np.broadcast_to(np.arange(width), at.shape).copy()
        run = 1
        while run < width:
            shape = (rows, width // (2 * run), 2, run)
            p, r = (np.take_along_axis(v, order, 1).reshape(shape) for v in (at, room))
            place = np.empty(shape, dtype=np.int64)
            for own, other, ties in ((0, 1, False), (1, 0, True)):
                low = np.zeros(p[:, :, 0].shape, dtype=np.int64)  # how many of the other run stand before
                high = np.full_like(low, run)
                for _ in range(run.bit_length()):
                    open_ = low < high
                    mid = np.minimum((low + high) // 2, run - 1)
                    px, rx = np.take_along_axis(p[:, :, other], mid, 2), np.take_along_axis(r[:, :, other], mid, 2)
                    if ties:  # the left run wins ties: its element stands before unless ours is less
                        before = ~self.less(p[:, :, own], px, r[:, :, own], rx)
                    else:
                        before = self.less(px, p[:, :, own], rx, r[:, :, own])
                    low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
                place[:, :, own] = low + np.arange(run)
            target = place + (np.arange(shape[1]) * 2 * run)[None, :, None, None]
            sorted_ = np.empty_like(order)
            np.put_along_axis(sorted_, target.reshape(rows, width), order, 1)
            order, run = sorted_, 2 * run
        return order


def repeats(groups: np.ndarray, n: np.ndarray, anchor: np.ndarray, count: np.ndarray, strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each item, which of its windows also start in another item of its group (all, if it stands for two or more)."""
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    base = np.cumsum([0, *map(len, strings)])[:-1]
    at, room = base + anchor, length - anchor + count - 1  # bytes from the anchor to the segment's end
    suffixes = Suffixes(data)
    paint = np.zeros(int(count.sum()) + 1, dtype=np.int64)
    first = np.cumsum(count) - count
    np.add.at(paint, first[n > 1], 1)
    np.add.at(paint, (first + count)[n > 1], -1)
    _, index, size = np.unique(groups, return_index=True, return_counts=True)
    for width in (2, 4, 8, 16, 32, 64, 128):
        rows = np.flatnonzero((size > width // 2) & (size <= width) & (size > 1))
        if not len(rows):
            continue
        member = index[rows][:, None] + np.arange(width)
        real = np.arange(width) < size[rows][:, None]
        member = np.where(real, member, 0)
        order = suffixes.sort(np.where(real, at[member], -1), np.where(real, room[member], 0))
        member, real = np.take_along_axis(member, order, 1), np.take_along_axis(real, order, 1)
        p, r = at[member], np.where(real, room[member], 0)
        common = suffixes.right(p[:, :-1], p[:, 1:], np.minimum(r[:, :-1], r[:, 1:]))
        reach = common
        for d in range(1, width):
            if d > 1:
                reach = np.minimum(reach[:, :-1], common[:, d - 1:])
            x, y = member[:, :-d], member[:, d:]
            may = (real[:, :-d] & real[:, d:] & (reach + np.minimum(anchor[x], anchor[y]) >= length)).nonzero()
            if not len(may[0]):
                continue
            x, y, right = x[may], y[may], reach[may]
            left = suffixes.left(at[x], at[y], np.minimum(anchor[x], anchor[y]))
            hit = left + right >= length
            x, y, left, right = x[hit], y[hit], left[hit], right[hit]
            for k in range(0, len(x), 2000):  # the hashes are verified on the bytes
                span = np.arange(-int(left[k:k + 2000].max()), int(right[k:k + 2000].max()))
                inside = (span >= -left[k:k + 2000, None]) & (span < right[k:k + 2000, None])
                if (inside & (data[np.clip(at[x[k:k + 2000], None] + span, 0, len(data) - 1)] != data[np.clip(at[y[k:k + 2000], None] + span, 0, len(data) - 1)])).any():
                    raise ValueError("two strings share a hash; choose another base")
            for z in (x, y):  # windows whose anchor lies length - right to left bytes behind their start
                low, high = np.maximum(anchor[z] - left, 0), np.minimum(anchor[z] - (length - right), count[z] - 1)
                ok = low <= high
                np.add.at(paint, first[z[ok]] + low[ok], 1)
                np.add.at(paint, first[z[ok]] + high[ok] + 1, -1)
    # Marks of one item end inside it or with it, so the running sum needs no reset.
    covered = np.cumsum(paint)[:-1] > 0
    return np.split(covered, first[1:])


def spans(covered: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(covered.astype(np.int8), prepend=0, append=0)
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


RUNS = "key bigint, d1 bigint, d2 bigint, `from` int, `to` int"


def compared(items: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows of each item, from groups of equal ``key`` that fit a task."""
    def run(batches):
        held: list[dict] = []

        def close(rows):
            groups = np.array([r["key"] for r in rows])
            get = lambda k: np.array([r[k] for r in rows], dtype=np.int64)
            out = [(r["key"], r["d1"], r["d2"], a, b) for r, c in zip(rows, repeats(groups, get("n"), get("anchor"), get("count"), [r["bytes"] for r in rows], length))
                   for a, b in spans(c)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, [pa.int64()] * 3 + [pa.int32()] * 2)],
                                              names=["key", "d1", "d2", "from", "to"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                held += batch.slice(at, 1000).to_pylist()
                if len(held) >= BLOCK_ITEMS:
                    last = next(i for i in range(len(held) - 1, -1, -1) if i == 0 or held[i - 1]["key"] != held[i]["key"])
                    if last:
                        yield close(held[:last])
                        held = held[last:]
        if held:
            yield close(held)

    return items.repartition("key").sortWithinPartitions("key", "d1", "d2").mapInArrow(run, RUNS)


def narrowed(items: DataFrame, width: int, length: int) -> DataFrame:
    """Each item cut into ranges of ``width`` windows by their anchor's place; the key names the bytes the range has in common."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, out = part.to_pylist(), []
                strings = [r["bytes"] for r in rows]
                data, base = np.frombuffer(b"".join(strings), dtype=np.uint8), np.cumsum([0, *map(len, strings)])
                first, second = ByteHash(data), ByteHash(data, SECOND)
                for r, b, s in zip(rows, base.tolist(), strings):
                    high = r["anchor"]
                    low = high - r["count"] + 1  # the anchors' places in the item's windows
                    for block in range(low // width, high // width + 1):
                        x, y = block * width, block * width + width - 1
                        lo, hi = max(x, low), min(y, high)
                        core = (b + high - x, b + high - y + length) if y <= x + length else (b, b)
                        start, end = high - hi, high - lo + length
                        out.append((r["key"], r["d1"], r["d2"], r["n"], start, hi, hi - lo + 1, block, *core, b + start, b + end, s[start:end]))
                cols = list(zip(*out))
                c0, c1, s0, s1 = (np.array(c, dtype=np.int64) for c in cols[8:12])
                c0, c1 = np.maximum(c0, s0), np.minimum(c1, s1)  # a range at an item's edge has all of the core
                key = mix(first.of(c0, c1) + mix(np.array(cols[0], dtype=np.int64).view(_U) + np.array(cols[7], dtype=_U) * _U(4 * width + 1)))
                e1, e2 = digests(first, second, s0, s1, np.array(cols[5], dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.int32()), pa.array(key.view(np.int64)), pa.array(e1), pa.array(e2),
                     *(pa.array(c, pa.int32()) for c in cols[5:7]), pa.array(cols[12], pa.binary())],
                    names=["okey", "o1", "o2", "n", "start", "key", "d1", "d2", "anchor", "count", "bytes"])

    return items.mapInArrow(run, "okey bigint, o1 bigint, o2 bigint, n bigint, start int, key bigint, d1 bigint, d2 bigint, anchor int, count int, bytes binary")


def kinds(rows: DataFrame, weight) -> DataFrame:
    """Keys that stand for two or more strings, and whether all of those are the same."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("d1", "d2") for f in (F.min, F.max)]
    return (rows.groupBy("key").agg(weight.alias("total"), *ends).filter("total >= 2")
            .select("key", ((F.col("min_d1") == F.col("max_d1")) & (F.col("min_d2") == F.col("max_d2"))).alias("same")))




def in_one(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key: its ``spans`` in order, those that meet or overlap as one.

    A key is a string of bounded length, so what is gathered for it is bounded too; what is
    joined with its copies afterwards is one row a copy.
    """
    def merge(done, span):
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["from"].alias("from"), F.greatest(last["to"], span["to"]).alias("to"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["to"] + 1 >= span["from"]), longer).otherwise(F.concat(done, F.array(span)))

    spans = F.sort_array(F.flatten(F.collect_list("spans")))
    grouped = rows.groupBy(*keys).agg(spans.alias("spans"))
    return grouped.withColumn("spans", F.aggregate("spans", F.slice("spans", 1, 0), merge))


def moved(spans: str, by: str):
    """The spans of a part as spans of what it starts in."""
    return F.transform(spans, lambda x: F.struct((F.col(by) + x["from"]).cast("bigint").alias("from"), (F.col(by) + x["to"]).cast("bigint").alias("to")))


def settled(items: DataFrame, length: int, scratch: Scratch, level: int = 0) -> DataFrame:
    """(key, d1, d2, spans): repeated windows of distinct items whose keys are shared; ``items`` is a written table."""
    place = ["key", "d1", "d2"]
    sizes = items.groupBy("key").agg(F.count("*").alias("m"))
    large = scratch.keep(sizes.filter(F.col("m") > GROUP).select("key"), "large") if level < len(WIDTHS) else None
    if large is None or large.isEmpty():
        return scratch.keep(in_one(compared(items, length).select(*place, F.array(F.struct(F.col("from").cast("bigint").alias("from"), F.col("to").cast("bigint").alias("to"))).alias("spans")), place), "runs")
    small = scratch.keep(compared(items.join(large, "key", "left_anti"), length).select(*place, F.array(F.struct(F.col("from").cast("bigint").alias("from"), F.col("to").cast("bigint").alias("to"))).alias("spans")), "runs")
    rows = scratch.keep(narrowed(items.join(large, "key", "left_semi"), WIDTHS[level], length), "narrowed")
    kind = scratch.keep(kinds(rows, F.sum("n")), "kinds")
    hits = rows.join(kind, "key")
    whole = hits.filter("same").select("okey", "o1", "o2", F.array(F.struct(F.col("start").cast("bigint").alias("from"), (F.col("start") + F.col("count") - 1).cast("bigint").alias("to"))).alias("spans"))
    mixed = hits.filter("NOT same")
    below = mixed.groupBy("key", "d1", "d2").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in ("anchor", "count", "bytes")))
    below = scratch.keep(below, "items")
    inner = settled(below, length, scratch, level + 1)
    part = (mixed.select("okey", "o1", "o2", "start", "key", "d1", "d2").join(inner, ["key", "d1", "d2"])
            .select("okey", "o1", "o2", moved("spans", "start").alias("spans")))
    found = small.unionByName(whole.unionByName(part).withColumnsRenamed({"okey": "key", "o1": "d1", "o2": "d2"}))
    return scratch.keep(in_one(found, place), "runs")


def packed(docs: DataFrame) -> DataFrame:
    """Texts compressed before they are shuffled."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "th"), pa.array([pack(t) for t in text_bytes(batch)], pa.binary())],
                                             names=["doc_id", "th", "packed"])
    return docs.select("doc_id", "th", "text").mapInArrow(run, "doc_id bigint, th bigint, packed binary")


def cut_out(joined: DataFrame, length: int) -> DataFrame:
    """The items' bytes, from texts joined with the list of their segments."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for texts, wanted in zip(column(batch, "packed"), column(batch, "wanted")):
                text, rows = unpack(texts.as_py()), wanted.as_py()
                cut = [text[r["start"]:r["start"] + r["count"] - 1 + length] for r in rows]
                yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in rows], pa.int64()) for k in ("key", "d1", "d2", "n")),
                                                  *(pa.array([r[k] for r in rows], pa.int32()) for k in ("anchor", "count")), pa.array(cut, pa.binary())],
                                                 names=["key", "d1", "d2", "n", "anchor", "count", "bytes"])
    return joined.select("packed", "wanted").mapInArrow(run, ITEMS)


def repeated_windows(docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(doc_id, th, from, to): runs of windows of each text that start elsewhere too."""
    found = scratch.keep(segments(docs, length), "segments")
    kind = scratch.keep(kinds(found, F.count("*")), "kinds")
    hits = scratch.keep(found.join(kind, "key"), "hits")
    scratch.drop(found)
    scratch.drop(kind)
    place = ["doc_id", "th"]
    whole = hits.filter("same").select(*place, F.array(F.struct(F.col("start").cast("bigint").alias("from"), (F.col("start") + F.col("count") - 1).cast("bigint").alias("to"))).alias("spans"))
    mixed = hits.filter("NOT same")
    one = F.min(F.struct("th", "doc_id", "start", "count", "anchor")).alias("r")
    distinct = mixed.groupBy("key", "d1", "d2").agg(F.count("*").alias("n"), one)
    wanted = distinct.groupBy("r.doc_id", "r.th").agg(F.collect_list(F.struct("key", "d1", "d2", "n", "r.start", "r.count", "r.anchor")).alias("wanted"))
    texts = packed(docs).alias("t")
    joined = texts.join(wanted.alias("w"), F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.th") == F.col("w.th"))).select("packed", "wanted")
    items = scratch.keep(cut_out(joined, length).dropDuplicates(["key", "d1", "d2"]), "items")
    runs = settled(items, length, scratch)
    part = (mixed.select(*place, "start", "key", "d1", "d2").join(runs, ["key", "d1", "d2"])
            .select(*place, moved("spans", "start").alias("spans")))
    return scratch.keep(whole.unionByName(part).groupBy(*place).agg(F.flatten(F.collect_list("spans")).alias("runs")), "runs")


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the remaining bytes."""
    if length < GRAM:
        raise ValueError(f"length is {length}, but must be at least {GRAM}")
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    runs = repeated_windows(docs, length, scratch).alias("r")
    texts = packed(docs).alias("t")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc_id, raw, found in zip(column(batch, "doc_id").to_pylist(), column(batch, "packed"), column(batch, "runs")):
                text, kept, at, removed, n = unpack(raw.as_py()), [], 0, 0, 0
                for r in sorted((r["from"], r["to"]) for r in found.as_py() or ()):
                    low, high = r[0], r[1] + length
                    if low > at or not n:
                        kept.append(text[at:low])
                        n += 1
                        removed += high - low
                        at = high
                    elif high > at:
                        removed += high - at
                        at = high
                kept.append(text[at:])
                rest = b"".join(kept)
                out.append((doc_id, len(text), removed, n, hashlib.sha256(rest).hexdigest(), rest if with_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.string(), pa.binary()])],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = texts.join(runs, F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.th") == F.col("r.th")), "left")
    result = joined.select("t.doc_id", "packed", "runs").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return result if with_text else result.drop("kept")


@query("op1_repeated_substrings")
def repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that start twice."""
    return remove_repeats(documents(spark, sf_dir))
