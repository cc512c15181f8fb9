"""Language-model scores: a gated recurrent network in numpy, trained where the data is.

The output is factored: words are members of classes, and the network predicts first the
class, then the member in it; above ``ONE_GROUP`` members classes belong to groups, which
are predicted before. Every word that occurs ``LEAST`` times in training, at least the
``WORDS`` most frequent, and the end of a text are members of their own, in about as many
classes (and groups) as a class has members, so the network grows with the training words
and what a word costs with their square (cube) root; all rarer words share ``BUCKETS``
members by their first two bytes, within which a word has its smoothed share of the training
tokens. Output biases start at the members' frequencies, so
training starts from the unigram model.

Training passes over all training documents once, in ``ROUNDS`` parts by hash. In each
part every core trains a copy of the parameters on its own documents - truncated
backpropagation over windows of ``STEPS`` words on ``STREAMS`` texts at a time, the state
carried from window to window and reset at the start of a text; an update costs what the
window touched, not the size of the network. The words of a node meet its weights in pieces of
a few lengths, so that no step loops over nodes in Python. The copies are averaged class by
class, by the tokens of the class they saw; a task sends only those. Scoring carries the state
through each whole text.

Counts are over all training documents. The ``KNOWN`` most frequent words, and all members,
travel to the tasks with their counts; the counts of any other word of a text come by a join. Words are
runs of anything but ASCII white space, A to Z folded. A null text is its end alone;
repeated rows are scored each time; an empty table gives no rows, and without training
documents every word is unknown.
"""

from __future__ import annotations

import heapq
import math
import zlib
from itertools import repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, column, crc_of_id, documents, steps, text_bytes
from paystrata.llm.registry import query

HIDDEN = 16
#: Classes and members of the smallest network.
CLASSES, PER_CLASS = 16, 32
MEMBERS = CLASSES * PER_CLASS
BUCKETS = 128
#: Members up to which the classes are one group.
ONE_GROUP = 4096
WORDS = MEMBERS - BUCKETS - 1
#: Occurrences from which a word is learnt as itself.
LEAST = 32
KNOWN = 150_000
STREAMS, STEPS, ROUNDS = 512, 24, 2
RATE, CLIP = 0.01, 5.0
#: Bytes of text read, and words laid out into streams, at a time.
READ_BYTES, LAYOUT_WORDS = 4 << 20, 2_500_000
#: Words that meet a node's weights at a time, and numbers of an update: what is worked on stays in the cache.
PIECES, UPDATE = (2, 6, 16, 48, 128), 1 << 16
SUMS = ["row", "doc_id", "n_tokens", "n_known", "base", "share"]
#: Stands for the end of a text in the counts; no word holds white space.
END = "\n"
LN10 = float(np.log(10))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, their ends included."""
    folded = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")
    words = docs.select(F.explode(F.split(folded, " ")).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    ends = docs.agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(END).alias("word"), "n")
    return words.unionByName(ends)


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The words from the least count on at which they are at most ``limit``: no task sends more than its share.

    Counts are taken in steps of a sixteenth above 256, so that the table of steps stays small.
    """
    scale = F.floor(F.log2("n") * 16)
    step = F.when(F.col("n") < 256, F.col("n")).otherwise(scale + 128)  # 128 = log2(256) * 16
    steps_ = counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("least")).orderBy(F.desc("s")).collect()
    least, total = None, 0
    for r in steps_:
        total += r.k
        if total > limit:
            break
        least = r.least
    return counts.filter(F.col("n") >= least) if least is not None else counts.limit(0)


def shape(members: int) -> tuple[int, int, int]:
    """Groups, classes of each and members of each class, that hold so many members."""
    if members <= MEMBERS:
        return 1, CLASSES, PER_CLASS
    if members <= ONE_GROUP:
        classes = math.isqrt(members - 1) + 1
        return 1, classes, -(-members // classes)
    side = round(members ** (1 / 3)) - 1
    while side ** 3 < members:
        side += 1
    return side, side, side


def bucket(word: bytes) -> int:
    return zlib.crc32(word[:2]) % BUCKETS


class Vocabulary:
    """The known words with their counts, the members, and how a bucket's words share it."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
        self.tokens, self.distinct = total.n or 0, total.v
        words = counts.filter(F.col("word") != END)
        self.members = math.prod(shape(max(WORDS, words.filter(F.col("n") >= LEAST).count()) + 1 + BUCKETS))
        self.own = self.members - 1 - BUCKETS
        rows = most_frequent(words, max(KNOWN, self.own)).collect()
        rows.sort(key=lambda r: (-r.n, r.word))
        end = counts.filter(F.col("word") == END).first()
        self.end_count = end.n if end else 0
        self.words = [r.word.encode() for r in rows]
        self.counts = np.array([r.n for r in rows], dtype=np.int64)
        own = min(self.own, len(rows))
        buckets = np.array([bucket(w) for w in self.words], dtype=np.int64)
        rest = F.crc32(F.substring(F.col("word").cast("binary"), 1, 2)) % BUCKETS
        mass, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for r in words.groupBy(rest.alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
            mass[r.b], kinds[r.b] = r.n, r.v
        mass -= np.bincount(buckets[:own], self.counts[:own], BUCKETS)
        kinds -= np.bincount(buckets[:own], minlength=BUCKETS)
        self.bucket_base = np.log10(mass + 0.5 * (kinds + 1))
        # Members by frequency: own words and the end first, then the buckets, each in classes of equal size.
        weight = np.concatenate((self.counts[:own], np.zeros(self.own - own), [self.end_count]))
        place = np.empty(self.own + 1, dtype=np.int64)
        place[np.argsort(-weight, kind="stable")] = np.arange(self.own + 1)
        self.end = int(place[self.own])
        bucket_place = np.empty(BUCKETS, dtype=np.int64)
        bucket_place[np.argsort(-mass, kind="stable")] = self.own + 1 + np.arange(BUCKETS)
        self.bucket_member = bucket_place
        self.member = np.concatenate((place[:own], bucket_place[buckets[own:]]))
        self.share = np.concatenate((np.zeros(own), np.log10(self.counts[own:] + 0.5) - self.bucket_base[buckets[own:]]))
        self.frequency = np.zeros(self.members)
        self.frequency[place], self.frequency[bucket_place] = weight, mass

    def plain(self) -> dict:
        """What the tasks need, of plain types."""
        return dict(vars(self))


def initial(frequency: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    groups, classes, size = shape(len(frequency))
    f = (frequency + 0.5).reshape(groups, classes, size)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    share = lambda f: np.log(f / f.sum(-1, keepdims=True)).astype(np.float32)
    params = {"gates": small(len(frequency) + 1, 3 * HIDDEN), "state": small(HIDDEN, 3 * HIDDEN), "class": small(groups, HIDDEN, classes),
              "member": small(groups * classes, HIDDEN, size), "class_bias": share(f.sum(2)), "member_bias": share(f).reshape(-1, size)}
    if groups > 1:
        params |= {"group": small(1, HIDDEN, groups), "group_bias": share(f.sum((1, 2)))[None]}
    return params


def pieces(counts: np.ndarray):
    """(node, words, which are real) of the pieces of one length each; the words of a node stand side by side, in order of the nodes.

    A piece that a node does not fill points behind the last word.
    """
    ends = np.cumsum(counts)
    full, rest = np.divmod(counts, PIECES[-1])
    shorter = 0
    for length in PIECES:
        many = ((rest > shorter) & (rest <= length)).astype(np.int64)
        if length == PIECES[-1]:
            many += full
        node = np.repeat(np.arange(len(counts)), many)
        if len(node):
            nth = np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many)
            # Pieces of the last length come first, the rest of a node behind them.
            first = ends[node] - counts[node] + (nth if length == PIECES[-1] else full[node]) * PIECES[-1]
            at = first[:, None] + np.arange(length)
            real = at < ends[node][:, None]
            yield node, np.where(real, at, ends[-1]), real
        shorter = length


class Network:
    """Gated recurrent units over member ids; the id after the last member stands before a text."""

    def __init__(self, params: dict[str, np.ndarray], learns: bool = True):
        self.p = params
        self.updates = 0
        self.classes, _, self.size = params["member"].shape
        self.per_group = params["class"].shape[2]
        self.levels = [x for x in ("group", "class", "member") if x in params]
        if learns:
            self.first = {k: np.zeros_like(v) for k, v in params.items()}
            self.second = {k: np.zeros_like(v) for k, v in params.items()}
            #: Gradients of the parameters that have rows; only the rows the last window touched count.
            self.rows = {k: np.zeros_like(params[k]) for x in self.levels for k in (x, f"{x}_bias")} | {"gates": np.zeros_like(params["gates"])}
            self.touched = {k: np.zeros(0, dtype=np.int64) for k in self.rows}

    def forward(self, before: np.ndarray, fresh: np.ndarray, h: np.ndarray):
        """States after each word; ``fresh`` marks the first word of a text, whose state starts from zero."""
        g, u, kept, states = self.p["gates"][before], self.p["state"], [], np.empty((*before.shape, HIDDEN), dtype=np.float32)
        going = np.logical_not(fresh).astype(np.float32)[:, :, None]
        one, two = np.float32(1), np.float32(2)
        for t in range(len(before)):
            h = h * going[t]
            m, x = h @ u, g[t]
            a = m[:, :2 * HIDDEN] + x[:, :2 * HIDDEN]
            np.negative(a, out=a)
            np.exp(a, out=a)
            a += one
            np.reciprocal(a, out=a)
            z, r = a[:, :HIDDEN], a[:, HIDDEN:]
            n = r * m[:, 2 * HIDDEN:]
            n += x[:, 2 * HIDDEN:]
            n *= -two
            np.exp(n, out=n)
            n += one
            np.reciprocal(n, out=n)
            n *= two
            n -= one
            kept.append((h, m[:, 2 * HIDDEN:], z, r, n))
            h = h - n
            h *= z
            h += n
            states[t] = h
        return states, kept, h

    def output(self, states: np.ndarray, target: np.ndarray, learn: bool):
        """Log-probability of each target member and, to learn, the gradients of its negative sum."""
        states, kind = states.reshape(-1, HIDDEN), (target // self.size).astype(np.int32)
        n, order = len(kind), np.argsort(kind.astype(np.int16) if self.classes < 1 << 15 else kind, kind="stable")  # words of a class side by side
        flat = np.zeros((n + 1, HIDDEN), dtype=states.dtype)  # the row behind the last fills up pieces
        flat[:n] = states[order]
        kind, inside = kind[order], (target % self.size)[order]
        group = kind // self.per_group
        logp, back, grads = np.zeros(n + 1, dtype=states.dtype), np.zeros_like(flat) if learn else None, {}
        for level, node, pick in (("group", np.zeros_like(group), group), ("class", group, kind - group * self.per_group), ("member", kind, inside)):
            if level in self.p:
                self._level(level, flat, node, pick, logp, back)
                grads |= {k: self.rows[k] for k in (level, f"{level}_bias")} if learn else {}
        out = np.empty_like(logp[:n])
        out[order] = logp[:n]
        if learn:
            given = np.empty_like(back[:n])
            given[order] = back[:n]
            back = given
        return out, grads or None, back

    def _level(self, level: str, flat: np.ndarray, node: np.ndarray, pick: np.ndarray, logp: np.ndarray, back: np.ndarray | None) -> None:
        """Adds the log-probability of the pick of each word among its node's choices and, to learn, the gradients of its negative."""
        weights, bias = self.p[level], self.p[f"{level}_bias"]
        width, learn = weights.shape[2], back is not None
        counts = np.bincount(node, minlength=len(weights))
        pick, ones = np.append(pick, 0), np.ones(width, dtype=flat.dtype)
        if learn:
            touched = np.flatnonzero(counts)
            slot = np.zeros(len(weights), dtype=np.int64)
            slot[touched] = np.arange(len(touched))
            grad, grad_bias = np.zeros((len(touched), HIDDEN, width), dtype=flat.dtype), np.zeros((len(touched), width), dtype=flat.dtype)
        for nodes, at, real in pieces(counts):
            s, w = flat[at], weights[nodes]
            x = s @ w
            x += bias[nodes][:, None, :]
            if not (x.max() < 60 and x.min() > -60):  # else exponentials and their sum are safe as they are
                x -= x.max(2, keepdims=True)
            chosen = np.arange(at.size) * width + pick[at].ravel()
            picked = x.reshape(-1)[chosen]
            np.exp(x, out=x)
            total = x.reshape(-1, width) @ ones
            logp[at] += (picked - np.log(total)).reshape(at.shape)
            if learn:
                x *= (real / total.reshape(at.shape))[:, :, None].astype(x.dtype)
                x.reshape(-1)[chosen] -= real.ravel()
                back[at] += x @ w.swapaxes(1, 2)
                g, g_bias = s.swapaxes(1, 2) @ x, x.sum(1)
                first = np.flatnonzero(np.diff(nodes, prepend=-1))
                if len(first) < len(nodes):
                    nodes, g, g_bias = nodes[first], np.add.reduceat(g, first, axis=0), np.add.reduceat(g_bias, first, axis=0)
                grad[slot[nodes]] += g
                grad_bias[slot[nodes]] += g_bias
        if learn:
            self.touched[level] = self.touched[f"{level}_bias"] = touched
            self.rows[level][touched], self.rows[f"{level}_bias"][touched] = grad, grad_bias

    def learn(self, before, fresh, target, h, real=None):
        """One window: gradients through its steps, one update; returns the state to carry on.
        ``real`` marks the words that count."""
        real = np.ones(before.shape, dtype=bool) if real is None else real
        states, kept, h_end = self.forward(before, fresh, h)
        _, grads, own = self.output(states[real], target[real], True)
        back = np.zeros_like(states)
        back[real] = own
        u, dh, du = self.p["state"], np.zeros_like(h_end), np.zeros_like(self.p["state"])
        going = np.logical_not(fresh).astype(h_end.dtype)[:, :, None]
        dg = np.empty((*before.shape, 3 * HIDDEN), dtype=np.float32)
        for t in range(len(before) - 1, -1, -1):
            h0, m, z, r, n = kept[t]
            dh = dh + back[t]
            dn = dh * (1 - z) * (1 - n * n)
            d = dg[t]
            d[:, :HIDDEN] = dh * (h0 - n) * z * (1 - z)
            d[:, HIDDEN:2 * HIDDEN] = dn * m * r * (1 - r)
            d[:, 2 * HIDDEN:] = dn
            dm = np.concatenate((d[:, :2 * HIDDEN], dn * r), 1)
            du += h0.T @ dm
            dh = (dh * z + dm @ u.T) * going[t]
        flat, members = dg.reshape(-1, 3 * HIDDEN), before.reshape(-1).astype(np.int32)
        order = np.argsort(members, kind="stable")
        starts = np.flatnonzero(np.diff(members[order], prepend=-1))
        self.touched["gates"] = members[order][starts]
        grads["gates"] = self.rows["gates"]
        grads["gates"][self.touched["gates"]] = np.add.reduceat(flat[order], starts, axis=0)
        grads["state"] = du
        self.update(grads, 1.0 / max(int(real.sum()), 1))
        return h_end

    def update(self, grads: dict[str, np.ndarray], scale: float) -> None:
        """One step of Adam; rows that the window did not touch stay as they are."""
        blocks = []
        for name, g in grads.items():
            rows = self.touched.get(name, np.arange(len(g)))
            step = max(1, UPDATE // max(1, g[0].size))
            blocks += [(name, rows[at:at + step]) for at in range(0, len(rows), step)]
        norm = scale * math.sqrt(sum(float(np.vdot(g, g)) for g in (grads[name][at] for name, at in blocks)))
        scale *= min(1.0, CLIP / max(norm, 1e-12))
        self.updates += 1
        k = self.updates
        for name, at in blocks:
            g, a, b = grads[name][at], self.first[name][at], self.second[name][at]
            g *= np.float32(scale)
            t = g - a
            t *= np.float32(0.1)
            a += t
            self.first[name][at] = a
            g *= g
            g -= b
            g *= np.float32(0.001)
            b += g
            self.second[name][at] = b
            b /= np.float32(1 - 0.999 ** k)
            np.sqrt(b, out=b)
            b += np.float32(1e-8)
            a /= np.float32(1 - 0.9 ** k)
            a *= np.float32(RATE)
            a /= b
            self.p[name][at] -= a


def streams(members: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Texts dealt to at most ``STREAMS`` streams, longest first to the shortest stream: (members, text of each), by falling length."""
    heap = [(0, s) for s in range(min(STREAMS, len(members)))]
    of: list[list[int]] = [[] for _ in heap]
    for i in sorted(range(len(members)), key=lambda i: -len(members[i])):
        length, s = heap[0]
        of[s].append(i)
        heapq.heapreplace(heap, (length + len(members[i]), s))
    made = [(np.concatenate([members[i] for i in own]), np.repeat(np.array(own, dtype=np.int32), [len(members[i]) for i in own])) for own in of if own]
    return sorted(made, key=lambda x: -len(x[0]))


def windows(members: list[np.ndarray], start: int = MEMBERS):
    """(inputs, first words, targets, texts, streams still running) of each window of steps.

    ``start`` stands before a text. A stream that ends inside a window is filled up; the text of such an entry is -1.
    """
    laid = streams(members)
    if not laid:
        return
    sizes = np.array([len(x) for x, _ in laid])
    wide = -(-int(sizes[0]) // STEPS) * STEPS
    every = np.zeros((wide + 1, len(laid)), dtype=np.int32)
    text = np.full((wide + 1, len(laid)), -1, dtype=np.int32)
    every[0] = start
    for k, (x, t) in enumerate(laid):
        every[1:len(x) + 1, k], text[1:len(x) + 1, k] = x, t
    fresh = text[1:] != text[:-1]
    for at in range(0, wide, STEPS):
        n = int((sizes > at).sum())
        rows = slice(at, min(at + STEPS, int(sizes[0])))
        begin = fresh[rows, :n]
        after = slice(rows.start + 1, rows.stop + 1)
        yield np.where(begin, start, every[rows, :n]).astype(np.int64), begin, every[after, :n].astype(np.int64), text[after, :n], n


class Reader:
    """Texts to members and to what the counts say, in a task."""

    def __init__(self, vocabulary: dict):
        self.v = SimpleNamespace(**vocabulary)
        self.get = dict(zip(self.v.words, range(len(self.v.words)))).get

    def read(self, text: bytes):
        words = text.lower().split()
        ids = np.fromiter(map(self.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        members = np.empty(len(ids) + 1, dtype=np.int32)
        members[-1] = self.v.end
        members[:-1] = self.v.member[ids] if len(self.v.words) else 0
        rest = np.flatnonzero(ids < 0)
        others = [words[i] for i in rest.tolist()]
        shared = np.array([bucket(w) for w in others], dtype=np.int64)
        members[rest] = self.v.bucket_member[shared]
        return ids[ids >= 0], members, others, shared


def averages(copies: DataFrame, kind: str = "<f4") -> DataFrame:
    """(part, weight, params): mean of the copies of each part, weighted and summed in double precision."""
    def run(batches):
        totals, weights = {}, {}
        for batch in batches:
            for k, w, raw in zip(*(column(batch, c).to_pylist() for c in ("part", "weight", "params"))):
                values = np.frombuffer(raw, dtype=kind).astype(np.float64) * w
                totals[k], weights[k] = (totals[k] + values, weights[k] + w) if k in totals else (values, w)
        for k in totals:
            mean = (totals[k] / weights[k]).astype(kind).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([weights[k]]), pa.array([mean], pa.binary())], names=["part", "weight", "params"])

    return copies.select("part", "weight", "params").repartition("part").mapInArrow(run, "part int, weight double, params binary")


def average(copies: DataFrame) -> np.ndarray | None:
    """Mean of copies that are one part, weighted."""
    row = averages(copies.withColumn("part", F.lit(0)), "<f8").first()
    return np.frombuffer(row.params, "<f8") if row else None


def parts(params: dict[str, np.ndarray]) -> list[list[np.ndarray]]:
    """Views of the parameters: those of each class and its members, and last what all words share."""
    classes, _, size = params["member"].shape
    own = [[params["member"][c], params["member_bias"][c], params["gates"][c * size:(c + 1) * size]] for c in range(classes)]
    return [*own, [params[k] for k in ("state", "class", "class_bias", "group", "group_bias") if k in params] + [params["gates"][-1:]]]


def flat(part: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([x.reshape(-1) for x in part])


def put(part: list[np.ndarray], values: np.ndarray) -> None:
    at = 0
    for x in part:
        x[...] = values[at:at + x.size].reshape(x.shape)
        at += x.size


ENCODED = ("row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, share double, others array<string>, members binary")


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each text read once: its members, what the known words add to its scores, and its other words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.plain())

    def run(batches):
        reader, row, pack = Reader(shared.value), TaskContext.get().partitionId() << 40, zstandard.ZstdCompressor(level=1).compress
        v = reader.v
        known, end = np.log10(v.counts + 0.5), np.log10(v.end_count + 0.5)
        for batch in steps(batches, limit=READ_BYTES):
            read = [reader.read(t) for t in text_bytes(batch)]
            offsets = np.cumsum([0, *(len(r[2]) for r in read)]).astype(np.int32)
            others = pa.ListArray.from_arrays(pa.array(offsets), pa.array([w for r in read for w in r[2]], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(len(read))), column(batch, "doc_id"), pa.array([len(r[1]) for r in read], pa.int64()),
                 pa.array([len(r[0]) + (v.end_count > 0) for r in read], pa.int64()), pa.array([known[r[0]].sum() + end for r in read], pa.float64()),
                 pa.array([v.share[r[0]].sum() - v.bucket_base[r[3]].sum() for r in read], pa.float64()), others,
                 pa.array([pack(r[1].astype("<i4").tobytes()) for r in read], pa.binary())],
                names=["row", "doc_id", "n_tokens", "n_known", "base", "share", "others", "members"])
            row += len(read)

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def unpacked(batches):
    """Batches with the member arrays of their texts, of about ``LAYOUT_WORDS`` words."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        ends = np.cumsum(column(batch, "n_tokens").to_numpy())
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LAYOUT_WORDS, "right")))
            part = batch.slice(at, to - at)
            yield part, [np.frombuffer(unpack(x), dtype="<i4") for x in column(part, "members").to_pylist()]
            at = to


def train(encoded: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    params = initial(vocabulary.frequency)
    # As many copies as cores: what they send does not grow with the texts.
    cores = encoded.sparkSession.sparkContext.defaultParallelism
    part, members_ = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(ROUNDS)), vocabulary.members
    for k in range(ROUNDS):
        shared = encoded.sparkSession.sparkContext.broadcast(params)

        def run(batches, shared=shared):
            network, seen = Network({name: v.copy() for name, v in shared.value.items()}), 0
            for _, members in unpacked(batches):
                h = np.zeros((min(STREAMS, len(members)), HIDDEN), dtype=np.float32)
                for before, fresh, target, text, n in windows(members, members_):
                    real = text >= 0
                    h = network.learn(before, fresh, target, h[:n], real)
                    seen = seen + np.bincount(target[real] // network.size, minlength=network.classes)
            if np.any(seen):
                for i, (own, weight) in enumerate(zip(parts(network.p), [*seen.tolist(), int(seen.sum())])):
                    if weight:
                        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([float(weight)]), pa.array([flat(own).astype("<f4").tobytes()], pa.binary())],
                                                         names=["part", "weight", "params"])

        copies = encoded.filter(part == k).select("n_tokens", "members").coalesce(cores).mapInArrow(run, "part int, weight double, params binary")
        params = {name: v.copy() for name, v in params.items()}
        into = parts(params)
        for r in averages(copies).collect():
            put(into[r.part], np.frombuffer(r.params, "<f4"))
    return params


def score(encoded: DataFrame, counts: DataFrame, vocabulary: Vocabulary, params: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every text; ``encoded`` is a written table."""
    shared, start = encoded.sparkSession.sparkContext.broadcast(params), vocabulary.members

    def run(batches):
        network = Network(shared.value, learns=False)
        for batch, members in unpacked(batches):
            total = np.zeros(len(members))
            h = np.zeros((min(STREAMS, len(members)), HIDDEN), dtype=np.float32)
            for before, fresh, target, text, n in windows(members, start):
                states, _, h = network.forward(before, fresh, h[:n])
                real = text >= 0
                total += np.bincount(text[real], network.output(states[real], target[real], False)[0], len(members))
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in SUMS), pa.array(total / LN10)], names=[*SUMS, "path"])

    rows = encoded.select(*SUMS, "members").mapInArrow(run, "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, share double, path double")
    rare = encoded.select("row", F.explode("others").alias("word")).groupBy("row", "word").agg(F.count("*").alias("k"))
    n = F.coalesce("n", F.lit(0))
    rest = (rare.join(counts, "word", "left").groupBy("row")
            .agg(F.sum(F.col("k") * F.log10(n + 0.5)).alias("more"), F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("seen")))
    more = F.coalesce("more", F.lit(0.0))
    base = F.col("base") + more - F.col("n_tokens") * float(np.log10(vocabulary.tokens + 0.5 * (vocabulary.distinct + 1)))
    return rows.join(rest, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), (F.col("path") + F.col("share") + more).alias("score"))


@query("op3_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and network scores of every document, learnt outside the held-out fold."""
    scratch = Scratch(spark)
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    held = crc_of_id("doc_id") % 5 == 1
    learn = docs.filter(~held)
    counts = scratch.keep(word_counts(learn), "counts")
    vocabulary = Vocabulary(counts)
    encoded = scratch.keep(encode(docs, vocabulary), "encoded")
    params = train(encoded.filter(~held), vocabulary)
    scored = score(encoded, counts, vocabulary, params)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
