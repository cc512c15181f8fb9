"""Which terms of a table occur in which texts: an automaton per block of the table.

``classify.match_terms`` puts a short constant list into one expression. Here the terms are a
table of any size. Its spellings are dealt by hash into blocks of at most ``BLOCK_BYTES``
(measured, and dealt again into twice as many while a block is larger); a block is sent to
the tasks, which build one Aho-Corasick automaton of it and read each text once. Work is one
reading of the texts a block, whatever the number of terms in it, and no pair of a text and
a term that does not occur in it is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from paystrata.session import materialize

#: UTF-8 bytes of the terms of one block (a single longer term is a block of its own).
BLOCK_BYTES = 4 << 20
#: Rows found before a task hands them on.
ROWS = 50_000


def _hits(automaton, text: str) -> dict[str, list[int]]:
    """Per spelling found: start of the first occurrence (from 1), occurrences, end of the last."""
    found: dict[str, list[int]] = {}
    for end, key in automaton.iter(text):
        start = end + 1 - len(key)
        seen = found.get(key)
        if seen is None:
            found[key] = [start + 1, 1, end]
        elif start > seen[2]:
            seen[1] += 1
            seen[2] = end
    return found


def term_blocks(terms: DataFrame, term: str, ci: bool, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[int]]:
    """(key, term, block) of the different terms, and the blocks that hold any."""
    key = F.lower("term") if ci else F.col("term")
    named = terms.select(F.col(term).cast("string").alias("term")).filter("term <> ''").distinct().select(
        key.alias("key"), "term")
    named = materialize(named, "terms")
    size = F.octet_length("key") + F.octet_length("term")
    total = named.agg(F.sum(size)).first()[0]
    count = max(1, -(-(total or 0) // block_bytes))
    while True:
        dealt = named.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(count)).cast("long"))
        sizes = dealt.groupBy("block").agg(F.sum(size).alias("bytes"), F.count_distinct("key").alias("keys")).collect()
        if all(r["bytes"] <= block_bytes or r["keys"] == 1 for r in sizes):
            return dealt, sorted(r["block"] for r in sizes)
        count *= 2


def find_terms(texts: DataFrame, text: str, terms: DataFrame, term: str, ids: list[str], ci: bool = False,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``texts`` and term that occurs in it: ``ids``, term, first, hits.

    ``first`` is the code point where the first occurrence starts, from 1; ``hits`` counts
    occurrences that do not overlap, from the left. With ``ci`` both sides are lower-cased,
    places are those of the lower-cased text, and each spelling of a term is reported.
    Null and empty terms and null texts match nothing; repeated terms count once, repeated
    rows of ``texts`` are reported each. Other columns are left out; ids named like one of
    the new columns are refused.
    """
    clash = {"term", "first", "hits", "__text"} & set(ids)
    if clash:
        raise ValueError(f"rename these ids first: {sorted(clash)}")
    spark = texts.sparkSession
    source = F.lower(F.col(text)) if ci else F.col(text)
    read = texts.select(*ids, source.alias("__text"))
    schema = StructType([*read.select(*ids).schema, StructField("term", StringType()),
                         StructField("first", LongType()), StructField("hits", LongType())])
    dealt, blocks = term_blocks(terms, term, ci, block_bytes)
    if not blocks:
        return spark.createDataFrame([], schema)

    def search(block: int) -> DataFrame:
        rows = dealt.filter(F.col("block") == block).select("key", "term").collect()
        sent = spark.sparkContext.broadcast([(r["key"], r["term"]) for r in rows])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            spellings: dict[str, list[str]] = {}
            for key, spelling in sent.value:
                spellings.setdefault(key, []).append(spelling)
            automaton = ahocorasick.Automaton()
            for key in spellings:
                automaton.add_word(key, key)
            automaton.make_automaton()

            def rows_of(batch: pa.RecordBatch, at: list, names: list, first: list, hits: list) -> pa.RecordBatch:
                kept = batch.select(ids).take(pa.array(at, pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(names, pa.string()), pa.array(first, pa.int64()), pa.array(hits, pa.int64())],
                    names=[*ids, "term", "first", "hits"])

            for batch in batches:
                out: tuple[list, list, list, list] = ([], [], [], [])
                for i, value in enumerate(batch.column("__text")):
                    content = value.as_py()
                    if not content:
                        continue
                    for key, (first, hits, _) in _hits(automaton, content).items():
                        for spelling in spellings[key]:
                            for column, cell in zip(out, (i, spelling, first, hits)):
                                column.append(cell)
                    if len(out[0]) >= ROWS:
                        yield rows_of(batch, *out)
                        out = ([], [], [], [])
                if out[0]:
                    yield rows_of(batch, *out)

        return read.mapInArrow(scan, schema)

    return reduce(DataFrame.unionByName, [search(b) for b in blocks])
