"""Terms of a table found by automata, against plain searching."""

import random

import pytest

from paystrata.operators import terms


def brute(texts, words, ci=False):
    out = []
    for i, text in texts:
        for w in {w for w in words if w}:
            t, k = ((text or "").lower(), w.lower()) if ci else (text or "", w)
            if k in t:
                out.append((i, w, t.index(k) + 1, t.count(k)))
    return sorted(out)


def found(spark, texts, words, **more):
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "id long, body string, key string")
    table = spark.createDataFrame([(w, 1) for w in words], "name string, block int")
    return terms.find_terms(docs.repartition(3), "body", table, "name", ["id"], **more)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("ci", [False, True])
@pytest.mark.parametrize("block", [terms.BLOCK_BYTES, 200])
def test_equals_plain_search(spark, ci, block):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("abAB é😀") for _ in range(rng.randrange(80)))) for i in range(60)]
    words = ["".join(rng.choice("abAB é😀") for _ in range(rng.randrange(1, 5))) for _ in range(150)]
    assert rows(found(spark, texts, words, ci=ci, block_bytes=block)) == brute(texts, words, ci)


def test_nested_and_overlapping_terms(spark):
    texts = [(1, "aaaaa"), (2, "Crypto to FIAT")]
    words = ["a", "aa", "aaa", "Crypto", "Crypto to", "Crypto to FIAT", "to"]
    assert rows(found(spark, texts, words)) == brute(texts, words)


def test_nulls_empty_repeated_and_long(spark):
    texts = [(1, None), (2, ""), (3, "UPI upi"), (3, "UPI upi"), (None, "UPI"), (4, "x" * 300_000 + "UPI")]
    got = found(spark, texts, ["UPI", "UPI", None, "", "upi"], ci=True).collect()
    assert sorted((r["id"] or 0, r["term"], r["first"], r["hits"]) for r in got) == sorted(
        [(3, t, 1, 2) for t in ("UPI", "upi")] * 2 + [(0, t, 1, 1) for t in ("UPI", "upi")]
        + [(4, t, 300_001, 1) for t in ("UPI", "upi")])
    assert rows(found(spark, texts, [])) == [] and rows(found(spark, [], ["UPI"])) == []


def test_blocks_are_bounded(spark):
    table = spark.createDataFrame([(f"term {i}",) for i in range(3000)] + [("y" * 5000,)], "t string")
    dealt, blocks = terms.term_blocks(table, "t", False, 4000)
    sizes = dealt.selectExpr("block", "octet_length(key) + octet_length(term) AS n", "key").groupBy("block").agg(
        {"n": "sum", "key": "count"}).collect()
    assert len(sizes) == len(blocks) and all(r["sum(n)"] <= 4000 or r["count(key)"] == 1 for r in sizes)


def test_clashing_ids_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "term long, body string")
    with pytest.raises(ValueError, match="term"):
        terms.find_terms(docs, "body", docs.selectExpr("body AS t"), "t", ["term"])
