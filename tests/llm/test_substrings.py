"""Repeated substrings against brute force over all windows; the suffix sort against sorted()."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from paystrata.llm import substrings
from paystrata.llm.queries import QUERIES


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        spans = []
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept, at = b"", 0
        for x, y in spans:
            kept, at = kept + b[at:x], y
        out.append((d, len(b), sum(y - x for x, y in spans), len(spans), hashlib.sha256(kept + b[at:]).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    text = lambda k, a="abcdefgh é": "".join(rng.choice(a) for _ in range(k))
    passages, rows = [text(rng.choice([399, 400, 401, 700, 1500])) for _ in range(6)], []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            t = text(rng.randrange(300))
        elif kind == 1:
            t = text(rng.randrange(200)) + rng.choice(passages)[rng.randrange(40):] + text(rng.randrange(200))
        elif kind == 2:
            t = rng.choice(passages) * rng.choice([1, 2]) + text(5)
        elif kind == 3:
            t = "ab " * rng.randrange(400) + text(rng.randrange(50))
        elif kind == 4:
            p = list(rng.choice(passages))
            p[rng.randrange(len(p))] = "#"
            t = text(100) + "".join(p) + text(100)
        else:
            t = text(450) + passages[0] + text(450)  # the edges of a shared passage
        rows.append((i, t))
    return rows + [(None, passages[1]), (500, None), (501, ""), (3, rows[3][1]), (502, "x" * 1300), (503, "é" * 200), (504, "é" * 199)]


@pytest.mark.parametrize("group, step", [(64, 4 << 20), (4, 20_000), (1, 4 << 20)])
def test_against_brute_force(spark, monkeypatch, group, step):
    monkeypatch.setattr(substrings, "GROUP", group)
    monkeypatch.setattr(substrings, "BLOCK_ITEMS", 50)
    rows = corpus(group)
    expected = brute(rows, 400)
    assert sum(e[2] for e in expected) > 20_000
    assert result(substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))) == expected


def test_query_on_edge_rows(spark, edge_dir, edge, empty_dir):
    assert result(QUERIES["op1_repeated_substrings"](spark, edge_dir)) == brute([(r.doc_id, r.text) for r in edge.collect()], 400)
    assert QUERIES["op1_repeated_substrings"](spark, empty_dir).collect() == []


def test_query(spark, small, texts):
    assert result(QUERIES["op1_repeated_substrings"](spark, small)) == brute(texts.items(), 400)


def test_remaining_bytes(spark):
    rows = [(1, "a" * 10 + "0123456789" * 50), (2, "b" * 10 + "0123456789" * 50)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), with_text=True).collect()
    assert {r.doc_id: bytes(r.kept) for r in got} == {1: b"a" * 10, 2: b"b" * 10}


def test_suffix_sort():
    rng = np.random.default_rng(1)
    for alphabet in (1, 2, 4):
        data = rng.integers(97, 97 + alphabet, 3000).astype(np.uint8)
        suffixes = substrings.Suffixes(data)
        at = rng.integers(0, 2500, (7, 16))
        room = rng.integers(1, 400, (7, 16))
        at[2, 9:], room[2, 9:] = -1, 0
        order = suffixes.sort(at, room)
        for a, r, o in zip(at, room, order):
            key = [(0, bytes(data[s:s + n])) if s >= 0 else (1, b"") for s, n in zip(a, r)]
            assert [key[i] for i in o] == sorted(key)
        x, y = rng.integers(400, 2500, 200), rng.integers(400, 2500, 200)
        for f, sign in ((suffixes.right, 1), (suffixes.left, -1)):
            limit = rng.integers(0, 400, 200)
            for a, b, m, n in zip(x, y, limit, f(x, y, limit)):
                k = 0
                while k < m and data[a + k if sign > 0 else a - 1 - k] == data[b + k if sign > 0 else b - 1 - k]:
                    k += 1
                assert k == n


def test_sliding_minimum():
    v = np.random.default_rng(2).integers(0, 1000, 300)
    for width in (1, 2, 3, 7, 64, 300):
        assert substrings.least(v, width).tolist() == [v[i:i + width].min() for i in range(301 - width)]


def test_lengths_other_than_the_registered(spark):
    rng = random.Random(11)
    fresh = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passages = [fresh(n) for n in (1000, 1003, 1400, 2100) for _ in range(3)]
    rows = [(2 * i + k, fresh(300) + p + fresh(200)) for i, p in enumerate(passages) for k in (0, 1)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 1000).collect()
    assert {r.doc_id: r.n_removed for r in got if r.n_removed < len(passages[r.doc_id // 2])} == {}
    with pytest.raises(ValueError):
        substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 63)
