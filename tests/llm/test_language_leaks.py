"""Language held-out accuracy and edge rows; benchmark containment against brute force."""

import zlib

import numpy as np
import pytest
from paystrata.llm import decontaminate, langid
from paystrata.llm.queries import ORACLES, QUERIES

from compare import compare, duck


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op4_language"](spark, sf).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_language_edge_rows(spark, edge_dir, edge):
    rows = QUERIES["op4_language"](spark, edge_dir).collect()
    known = {r.lang for r in edge.collect() if r.lang and r.text and fold(r.doc_id, 4) != 2}
    assert len(rows) == edge.count()
    for r in rows:
        if r.doc_id in (1, 2, 3, 10):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in known


def test_labels_of_the_held_out_fold_are_not_read(spark, edge, tmp_path):
    rows = [(i, t, "xx" if fold(i, 4) == 2 else lang, "s") for i, (t, lang) in enumerate([("le la les des une", "fr"), ("der die das und ein", "de")] * 20)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.lang_pred for r in QUERIES["op4_language"](spark, str(tmp_path)).collect()}
    assert got == {i: ("fr", "de")[i % 2] for i in range(40)}


def test_empty_tables(spark, empty_dir, empty):
    assert QUERIES["op4_language"](spark, empty_dir).collect() == []
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert decontaminate.leaks(empty, items).collect() == []
    assert decontaminate.leaks(empty, items.limit(0)).collect() == []


def test_leaks_equal_sql(spark, small):
    assert compare(QUERIES["op2_decontamination"](spark, small), duck(small), ORACLES["op2_decontamination"]) == []


def brute(docs, items):
    out = []
    for d, text in docs:
        held = decontaminate.word_shingles((text or "").encode(), 5)
        for i, t in items:
            own = decontaminate.word_shingles((t or "").encode(), 5)
            if own and len(own & held) / len(own) >= 0.8:
                out.append((d, i, len(own), len(own & held)))
    return sorted(out, key=str)


def test_leaks_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate([5, 6, 9, 14, 30, 80, 4, 3])] + [(8, None), (9, ""), (10, " ".join(words[:12])), (10, " ".join(words[:12]))]
    docs = []
    for i in range(120):
        text = list(rng.choice(words, rng.integers(0, 600)))
        item = items[i % 11][1]
        if item:
            passage = item.upper().split()
            for k in rng.choice(len(passage), int(len(passage) * rng.choice([0, 0.03, 0.06]))):
                passage[k] = "changed,"
            at = rng.integers(0, len(text) + 1)
            text[at:at] = passage
        docs.append((i, " ".join(text)))
    docs += [(200, None), (200, ""), (None, items[4][1]), (3, docs[3][1])]
    table, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute(docs, items)
    assert len(expected) > 30
    for words_in_block in (1_000_000, 40):  # one block, many blocks
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words_in_block)
        got = decontaminate.leaks(table, bench).collect()
        assert sorted([tuple(r)[:4] for r in got], key=str) == expected


@pytest.mark.parametrize("text", ["", "   ", "日本語 テスト", "ß", "123 !?", "ª", "½Ⅷ"])
def test_has_letter(text):
    assert langid.has_letter(text.encode()) == any(map(str.isalpha, text))
