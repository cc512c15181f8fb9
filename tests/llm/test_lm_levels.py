"""Network of many members: three levels of choices, few copies, updates of touched rows."""

import numpy as np
import pytest
from paystrata.llm import lm
from paystrata.llm.common import Scratch


def test_what_a_word_meets_grows_with_the_cube_root():
    for members in (5_000, 60_000, 200_000):
        params = lm.initial(np.arange(np.prod(lm.shape(members)))[::-1])
        assert lm.shape(len(params["member_bias"].reshape(-1))) == lm.shape(members)
        assert sum(params[k].shape[2] for k in ("group", "class", "member")) <= 3.2 * members ** (1 / 3)
    assert "group" not in lm.initial(np.ones(lm.MEMBERS)) and "group" not in lm.initial(np.ones(41 * 40))


def test_three_levels_add_up_to_one():
    rng = np.random.default_rng(4)
    network = lm.Network(lm.initial(rng.random(17 ** 3) * 50), learns=False)
    for k, v in network.p.items():
        v += rng.standard_normal(v.shape).astype("f4") * (100 if k == "member_bias" else 1)  # also beyond what float exponentials hold
    states = np.repeat(rng.standard_normal((1, 1, lm.HIDDEN)).astype(np.float32), 17 ** 3, axis=0)
    assert np.exp(network.output(states, np.arange(17 ** 3), False)[0].astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_gradients_of_three_levels(monkeypatch):
    rng = np.random.default_rng(3)
    members = 17 ** 3
    params = {k: rng.standard_normal(v.shape) * 0.3 for k, v in lm.initial(np.ones(members)).items()}  # double precision
    target = rng.integers(0, members, (40, 3))
    target[::2] = rng.integers(0, 40, (20, 3))  # some classes have many words, most one or two
    before, fresh, h = rng.integers(0, members, (40, 3)), rng.random((40, 3)) < 0.3, rng.standard_normal((3, lm.HIDDEN)) * 0.5
    taken, network = {}, lm.Network(params)
    monkeypatch.setattr(network, "update", lambda grads, scale: taken.update(grads))
    network.learn(before, fresh, target, h)
    loss = lambda: -network.output(network.forward(before, fresh, h)[0].astype(np.float64), target.reshape(-1), False)[0].sum()
    monkeypatch.setattr(np, "float32", np.float64)
    assert set(taken) == set(params)
    for name, value in params.items():
        live = np.argwhere(np.abs(taken[name]) > 1e-2)
        for at in live[rng.choice(len(live), 6)]:
            at, kept = tuple(at), value[tuple(at)]
            value[at] = kept + 1e-4
            up = loss()
            value[at] = kept - 1e-4
            down = loss()
            value[at] = kept
            assert (up - down) / 2e-4 == pytest.approx(taken[name][at], rel=2e-2, abs=2e-3), name


def test_pieces_hold_each_word_once():
    rng = np.random.default_rng(8)
    counts = np.concatenate(([0, 1, 2, 3, 128, 129, 300, 0, 256], rng.integers(0, 200, 50)))
    node_of, seen = np.repeat(np.arange(len(counts)), counts), np.zeros(counts.sum(), dtype=int)
    for node, at, real in lm.pieces(counts):
        assert (np.diff(node) >= 0).all() and (at[~real] == len(seen)).all()
        np.add.at(seen, at[real], 1)
        assert (node_of[at[real]] == np.broadcast_to(node[:, None], at.shape)[real]).all()
    assert (seen == 1).all()


def test_copies_do_not_grow_with_the_partitions(spark, monkeypatch):
    rng = np.random.default_rng(6)
    docs = spark.createDataFrame([(k, " ".join(f"w{x}" for x in rng.integers(0, 40, 30))) for k in range(200)], "doc_id bigint, text string").repartition(20)
    scratch = Scratch(spark)
    v = lm.Vocabulary(scratch.keep(lm.word_counts(docs), "counts"))
    most, averages = [], lm.averages
    monkeypatch.setattr(lm, "averages", lambda copies: most.append(copies.groupBy("part").count().agg({"count": "max"}).first()[0]) or averages(copies))
    monkeypatch.setattr(lm, "ROUNDS", 1)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        lm.train(scratch.keep(lm.encode(docs, v), "encoded"), v)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert 0 < most[0] <= spark.sparkContext.defaultParallelism
