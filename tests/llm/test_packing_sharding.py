"""Packing covers every id once without padding; shards balance and keep equal texts together."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from paystrata.llm import packing, sharding
from paystrata.llm.queries import QUERIES
from paystrata.llm.tokens import tokenizer_path


def ids_of(rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows]


def check_pieces(pieces, docs, window=4096):
    """Every id in exactly one piece, sequences gapless, checksums right; returns the padding's share."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    copies = Counter(d for d, _ in docs)
    for d, ids in docs:
        covered = sorted((p.start, p.length) for p in by_doc[d] if p.doc_tokens == len(ids))
        if copies[d] == 1:
            at = 0
            for start, length in covered:
                assert start == at and length > 0
                at += length
            assert at == len(ids)
            for p in by_doc[d]:
                assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], dtype="<u4").tobytes())
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in docs)
    room = 0
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        room += at if at & (at - 1) == 0 else window
    return 1 - sum(len(ids) for _, ids in docs) / room if room else 0


def test_query_packs_everything(spark, small, texts):
    assert check_pieces(QUERIES["op7_packing"](spark, small).collect(), ids_of(texts.items())) == 0


def test_edge_rows(spark, edge_dir, edge):
    assert check_pieces(QUERIES["op7_packing"](spark, edge_dir).collect(), ids_of([(r.doc_id, r.text) for r in edge.collect()])) == 0


def test_empty_table(spark, empty_dir):
    assert QUERIES["op7_packing"](spark, empty_dir).collect() == []
    assert QUERIES["op6_sharding"](spark, empty_dir).collect() == []


def test_nnls_against_grid_and_optimality():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((6, 9)), rng.random(6) * 3
        x = packing.nnls(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gain <= 1e-6).all() and np.abs(gain * x).max() < 1e-6  # Karush-Kuhn-Tucker


def test_combinations_fill_the_window():
    combos = packing.combinations(16, 4)
    assert all(sum(c) == 16 and len(c) <= 4 for c in combos) and len(set(combos)) == len(combos)
    assert set(combos) == {tuple(sorted(c, reverse=True)) for k in (1, 2, 3, 4) for c in
                           __import__("itertools").product(range(1, 17), repeat=k) if sum(c) == 16}


def test_most_windows_come_from_the_mix():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 4096, 3000).tolist()
    mix = packing.fit_mix(Counter(-(-(n % 4096) // 64) for n in lengths if n % 4096))
    got = packing.pack(lengths, mix)
    assert sorted((d, sum(p[2] for s in got for p in s if p[0] == d)) for d in range(0, 3000, 97)) == [(d, lengths[d]) for d in range(0, 3000, 97)]
    assert sum(sum(p[2] for p in s) != 4096 for s in got) <= 12
    whole = sum(all(p[2] == lengths[p[0]] for p in s[:-1]) and len(s) <= 6 for s in got)
    assert whole > 0.7 * len(got)


def check_shards(rows, docs, shards=24):
    assert len(rows) == len(docs)
    sizes, slots, of = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == sorted(
        ((d or -1), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    return sizes, of


def test_shards_of_query(spark, small, texts):
    check_shards(QUERIES["op6_sharding"](spark, small).collect(), list(texts.items()))


def test_shards_balance(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op6_sharding"](spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    sizes, of = check_shards(rows, docs)
    mean = sum(sizes.values()) / 24
    assert max(sizes.values()) < 1.01 * mean and min(sizes.values()) > 0.99 * mean
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) < 1.05 * len(rows) / 24


def test_shards_of_edge_rows(spark, edge_dir, edge):
    check_shards(QUERIES["op6_sharding"](spark, edge_dir).collect(), [(r.doc_id, r.text) for r in edge.collect()])


def test_hot_group_is_cut_and_others_stay_together(spark, tmp_path):
    rows = [(i, "hot text of many copies") for i in range(800)] + [(1000 + i, f"text {i // 2} " * 3) for i in range(1600)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sizes, of = check_shards(QUERIES["op6_sharding"](spark, str(tmp_path)).collect(), rows)
    mean = sum(sizes.values()) / 24
    assert max(sizes.values()) < 1.1 * mean
    assert all(len(s) == 1 for crc, s in of.items() if crc != zlib.crc32(rows[0][1].encode()))


def test_write_shards(spark, edge, tmp_path):
    sharding.write_shards(edge, str(tmp_path / "s"), 3)
    got = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id or -1, r.text or "") for r in got.collect()) == sorted((r.doc_id or -1, r.text or "") for r in edge.collect())
