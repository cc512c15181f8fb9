"""Near-duplicate components against brute force: SQL, near copies, chains, hot buckets, edge rows."""

import random
import re

import pytest
from paystrata.llm import neardup
from paystrata.llm.components import components
from paystrata.llm.common import Scratch
from paystrata.llm.queries import ORACLES, QUERIES

from compare import compare, duck


def brute(docs, width=4, percent=80):
    sets = []
    for _, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    comp = list(range(len(docs)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and docs[i][0] is not None and docs[j][0] is not None:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if d is not None else None, d is None or least[root(i)] == d)
                   for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def result(spark, docs, width=4):
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    return sorted(map(tuple, neardup.near_duplicates(table, width).collect()), key=str)


def test_query_equals_sql(spark, small):
    assert compare(QUERIES["op5_near_duplicates"](spark, small), duck(small), ORACLES["op5_near_duplicates"]) == []


def test_edge_rows(spark, edge_dir, edge, empty_dir):
    got = sorted(map(tuple, QUERIES["op5_near_duplicates"](spark, edge_dir).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in edge.collect()])
    assert QUERIES["op5_near_duplicates"](spark, empty_dir).collect() == []


def changed(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"z{rng.randrange(10**6)}"
    return words


def corpus(seed, groups=12, size=12):
    """Near copies around the limit, chains of drifting copies, and unrelated texts with a shared passage."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts, passage = [], fresh(30)
    for g in range(groups):
        base = fresh(rng.choice([12, 40, 160]))
        for k in range(size):
            texts.append(changed(rng, base, rng.randrange(0, max(2, len(base) // 25))))
            if g % 3 == 0:
                base = texts[-1]  # the chain drifts
    texts += [fresh(40) + passage + fresh(40) for _ in range(20)]
    rng.shuffle(texts)
    return [(3 * i + 1, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small_bucket, rounds", [(48, 5), (3, 2), (2, 0)])
def test_against_brute_force(spark, monkeypatch, small_bucket, rounds):
    monkeypatch.setattr(neardup, "SMALL", small_bucket)
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    docs = corpus(small_bucket)
    assert result(spark, docs) == brute(docs)


def test_hot_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(changed(rng, base, 2))) for i in range(300)] + [(1000 + i, " ".join(base)) for i in range(200)]
    assert result(spark, docs) == brute(docs)


def test_five_words(spark):
    docs = corpus(4, groups=4)
    assert result(spark, docs, 5) == brute(docs, 5)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    order = list(range(100, 160))
    rng.shuffle(order)
    edges = [*zip(order, order[1:]), *((5, k) for k in range(200, 230)), (1, 2), (2, 2), (3, 1)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark)).collect()}
    assert got == {**{n: 100 for n in order}, 5: 5, **{k: 5 for k in range(200, 230)}, 1: 1, 2: 1, 3: 1}


def test_two_texts_under_one_id_are_two_nodes(spark):
    rng = random.Random(8)
    a, b, c = ([f"{x}{i}" for i in range(60)] for x in "abc")
    text = " ".join
    docs = [(5, text(a)), (5, text(b)), (3, text(changed(rng, b, 1))), (None, text(c)), (None, text(c)), (9, text(changed(rng, a, 1))), (7, "")]
    assert result(spark, docs) == brute(docs)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    kept = sorted(map(tuple, neardup.one_of_each(table, 4, Scratch(spark)).collect()), key=str)
    assert kept == sorted([docs[0], docs[2], docs[3], docs[6]], key=str)
