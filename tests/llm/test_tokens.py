"""Token ids, token files: equal to the library's own ids, exact round trip."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from paystrata.llm import huffman
from paystrata.llm.queries import QUERIES
from paystrata.llm.tokens import Encoder, slices, token_table, tokenizer_path


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


ODD = ["A<|endoftext|>b", "<|ENDOFTEXT|>", "x\x1cy z", "É́a café ﬁ Ⅷ ½ 5² ª µ", "I'LL don't O''s !'s", "", " a\xa0b\x85c", "ſ K İ Σας", "日本 語、テスト",
       "<|start", "😀👍🏽 ok", "é é ́a ạ́", None, "​zero‍width", "a" * 5000]


def test_encoder_equals_library(reference):
    ids, lengths = Encoder(tokenizer_path()).ids(pa.array(ODD))
    assert [[*x.tolist(), 2] for x in slices(ids, lengths)] == [reference(t) for t in ODD]


def test_encoder_after_its_cache_starts_anew(reference, monkeypatch):
    import paystrata.llm.tokens as tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    encoder = Encoder(tokenizer_path())
    for _ in range(2):
        for text in ("one two three", "four five six one", "two"):
            ids, _ = encoder.ids(pa.array([text]))
            assert [*ids.tolist(), 2] == reference(text)


def test_code_lengths_are_prefix_free_and_limited():
    rng = np.random.default_rng(1)
    for counts in ([5], [1, 1], [1, 2, 4, 8, 16, 32, 64, 128], 2 ** np.arange(30), rng.integers(1, 1000, 5000)):
        lengths = huffman.code_lengths(np.array(counts))
        assert lengths.max() <= huffman.MAX_BITS and (2.0 ** -lengths).sum() <= 1
    assert huffman.code_lengths(np.array([1, 1, 2, 4])).tolist() == [3, 3, 2, 1]


def test_encode_decode_blocks():
    rng = np.random.default_rng(2)
    ids = np.array([3, 7, 9, 40, 41, 42])
    codes = huffman.Codes(ids, huffman.code_lengths(np.array([100, 50, 20, 4, 2, 1])))
    blocks = [rng.choice(ids, n) for n in (0, 1, 255, 256, 257, 5000)]
    packed = [(lambda bits, at, b: (bits, at[::huffman.CHECKPOINT], len(b)))(*codes.encode(b), b) for b in blocks]
    assert [x.tolist() for x in codes.decode(packed)] == [b.tolist() for b in blocks]


def expected(rows, reference):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = reference(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_library(spark, small, texts, reference):
    got = sorted(tuple(r) for r in QUERIES["op10_token_files"](spark, small).collect())
    assert got == sorted(expected(texts.items(), reference))


def test_query_on_edge_rows(spark, edge_dir, edge, reference):
    got = QUERIES["op10_token_files"](spark, edge_dir).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected([(r.doc_id, r.text) for r in edge.collect()], reference)


def test_query_on_empty_table(spark, empty_dir):
    assert QUERIES["op10_token_files"](spark, empty_dir).collect() == []


def test_files_return_the_ids(spark, edge, tmp_path, reference):
    huffman.write_token_files(token_table(edge), str(tmp_path / "f"))
    got = huffman.read_token_files(spark, str(tmp_path / "f")).collect()
    assert {(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got} == {(r.doc_id, tuple(reference(r.text))) for r in edge.collect()}


def test_a_worker_lets_the_encoder_go_when_it_shingles():
    import weakref

    from paystrata.llm.common import ByteHash
    from paystrata.llm.tokens import encoder
    path = tokenizer_path()
    held = weakref.ref(encoder(path))
    assert encoder(path) is held()
    ByteHash(np.frombuffer(b"some words", dtype=np.uint8))
    assert held() is None
    ids, lengths = encoder(path).ids(pa.array(["one two", "one"]))
    assert lengths.tolist() == [len(ids) - lengths[1], lengths[1]]


def test_texts_come_to_the_encoder_in_batches_of_a_step(spark, small, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key)
    keep = huffman.Scratch.keep
    monkeypatch.setattr(huffman.Scratch, "keep", lambda self, df, label: (seen.append((label, int(spark.conf.get(key)))), keep(self, df, label))[1])
    QUERIES["op10_token_files"](spark, small)
    assert seen == [("tokens", huffman.BATCH_BYTES)] and huffman.BATCH_BYTES < huffman.ENCODE_BYTES
    assert spark.conf.get(key) == before
