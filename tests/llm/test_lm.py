"""Language model: counts and base scores by hand, gradients by differences, states across windows, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from paystrata.llm import lm
from paystrata.llm.common import Scratch
from paystrata.llm.queries import QUERIES


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def base(rows):
    counts = Counter(w for d, t in rows if fold(d) != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, [(d, fold(d) == 1, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)),
                sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for d, t in rows]


def check(got, rows):
    n, expected = base(rows)
    key = lambda r: (str(r[0]), r[2], r[4])
    got = sorted(([r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score] for r in got), key=key)
    for a, b in zip(got, sorted(expected, key=key), strict=True):
        assert a[:4] == list(b[:4]) and a[4] == pytest.approx(b[4], rel=1e-9)
    return n


@pytest.mark.parametrize("known", [150_000, 700])
def test_query(spark, small, texts, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    got = QUERIES["op3_lm_scores"](spark, small).collect()
    n = check(got, list(texts.items()))
    assert {r.train_tokens for r in got} == {n}
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    for held in (False, True):
        assert sum(r.score for r in got if r.held_out == held) > sum(r.base_score for r in got if r.held_out == held)


def test_edge_rows(spark, edge_dir, edge, empty_dir):
    got = QUERIES["op3_lm_scores"](spark, edge_dir).collect()
    check(got, [(r.doc_id, r.text) for r in edge.collect()])
    assert QUERIES["op3_lm_scores"](spark, empty_dir).collect() == []


def test_gradients_by_differences(monkeypatch):
    rng = np.random.default_rng(3)
    params = {k: rng.standard_normal(v.shape) * 0.3 for k, v in lm.initial(np.ones(lm.MEMBERS)).items()}  # double precision
    before, target = rng.integers(0, lm.MEMBERS, (5, 3)), rng.integers(0, lm.MEMBERS, (5, 3))
    fresh = rng.random((5, 3)) < 0.3
    h = rng.standard_normal((3, lm.HIDDEN)) * 0.5
    taken = {}
    network = lm.Network(params)
    monkeypatch.setattr(network, "update", lambda grads, scale: taken.update(grads))
    network.learn(before, fresh, target, h)
    loss = lambda: -network.output(network.forward(before, fresh, h)[0].astype(np.float64), target.reshape(-1), False)[0].sum()
    monkeypatch.setattr(np, "float32", np.float64)
    for name, value in params.items():
        live = np.argwhere(np.abs(taken[name]) > 1e-3)
        for at in live[rng.choice(len(live), min(6, len(live)), replace=False)]:
            at, kept = tuple(at), value[tuple(at)]
            value[at] = kept + 1e-4
            up = loss()
            value[at] = kept - 1e-4
            down = loss()
            value[at] = kept
            assert (up - down) / 2e-4 == pytest.approx(taken[name][at], rel=2e-2, abs=2e-3), name


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(4)
    network = lm.Network(lm.initial(rng.random(lm.MEMBERS) * 50))
    states = np.repeat(rng.standard_normal((1, 1, lm.HIDDEN)).astype(np.float32), lm.MEMBERS, axis=0)
    assert np.exp(network.output(states, np.arange(lm.MEMBERS), False)[0]).sum() == pytest.approx(1, abs=1e-4)


def test_windows_carry_the_state_through_whole_texts(monkeypatch):
    """Scores by windows over several streams equal those of each text alone, word by word."""
    rng = np.random.default_rng(5)
    network = lm.Network(lm.initial(np.ones(lm.MEMBERS)))
    texts = [rng.integers(0, lm.MEMBERS, n) for n in (1, 200, 3, 77, 24, 25, 48, 1, 130, 9)]
    monkeypatch.setattr(lm, "STREAMS", 3)
    total, h = np.zeros(len(texts)), np.zeros((3, lm.HIDDEN), dtype=np.float32)
    for before, fresh, target, text, n in lm.windows(texts):
        states, _, h = network.forward(before, fresh, h[:n])
        real = text >= 0  # a stream that ends inside a window is filled up
        np.add.at(total, text[real], network.output(states[real], target[real], False)[0])
    for i, x in enumerate(texts):
        h, alone = np.zeros((1, lm.HIDDEN), dtype=np.float32), 0.0
        for k, w in enumerate(x):
            states, _, h = network.forward(np.array([[lm.MEMBERS if k == 0 else x[k - 1]]]), np.array([[k == 0]]), h)
            alone += float(network.output(states, np.array([w]), False)[0][0])
        assert total[i] == pytest.approx(alone, rel=1e-4)


def test_average_weighs_by_tokens(spark):
    rows = [(float(w), np.full(3, float(w)).astype("<f8").tobytes()) for w in (1, 2, 5)]
    assert lm.average(spark.createDataFrame(rows, "weight double, params binary")) == pytest.approx([30 / 8] * 3)
    assert lm.average(spark.createDataFrame([], "weight double, params binary")) is None


def test_words_of_a_bucket_share_its_probability(spark):
    docs = spark.createDataFrame([(1, " ".join(f"word{i} " * (i % 7 + 1) for i in range(900)))], "doc_id bigint, text string")
    counts = Scratch(spark).keep(lm.word_counts(docs), "counts")
    v = lm.Vocabulary(counts)
    shares = Counter()
    for w, s in zip(v.words[lm.WORDS:], v.share[lm.WORDS:]):
        shares[lm.bucket(w)] += 10 ** s
    for b, total in shares.items():  # with the half for unknown words of the bucket
        assert total + 0.5 / 10 ** v.bucket_base[b] == pytest.approx(1)


def test_members_follow_the_training_words(spark, monkeypatch):
    """Every word that occurs often enough is learnt as itself, however many there are."""
    monkeypatch.setattr(lm, "LEAST", 20)
    rng = np.random.default_rng(6)
    after = rng.permutation(1500)
    rows = []
    for k in range(600):
        w, text = k * 5 % 1500, []
        for _ in range(100):
            text.append(f"aa{w}")  # all in one bucket by their first bytes
            w = after[w] if rng.random() < 0.95 else rng.integers(1500)
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    scratch = Scratch(spark)
    counts = scratch.keep(lm.word_counts(docs), "counts")
    often = counts.filter(f"n >= {lm.LEAST}").count()
    v = lm.Vocabulary(counts)
    assert often > 1000 and v.members >= often and len(set(v.member[:often - 1].tolist())) == often - 1 and not v.share[:often - 1].any()
    params = lm.initial(v.frequency)
    classes, _, size = params["member"].shape
    assert classes * size == v.members and abs(classes - size) <= 1
    network = lm.Network(params)
    states = np.repeat(rng.standard_normal((1, 1, lm.HIDDEN)).astype(np.float32), v.members, axis=0)
    assert np.exp(network.output(states, np.arange(v.members), False)[0]).sum() == pytest.approx(1, abs=1e-4)
    encoded = scratch.keep(lm.encode(docs, v), "encoded")
    learnt = lm.score(encoded, counts, v, lm.train(encoded, v)).selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert learnt.s > learnt.b


def test_query_with_a_larger_network(spark, small, texts, monkeypatch):
    monkeypatch.setattr(lm, "LEAST", 4)
    monkeypatch.setattr(lm, "KNOWN", 700)
    got = QUERIES["op3_lm_scores"](spark, small).collect()
    check(got, list(texts.items()))
    for held in (False, True):
        assert sum(r.score for r in got if r.held_out == held) > sum(r.base_score for r in got if r.held_out == held)
