"""Corpus pipeline over ``documents``: language, near copies, benchmark leaks, secrets, packing.

``run`` writes the result of each stage as Parquet to the shared folder and reads it again
for the next. A stage's own intermediate tables are removed when the next one starts, as
its result is written by then. All stages but the last return the columns of
``documents``; other columns of the input are left behind. Rows with null ids, null or
empty texts and repeated rows are treated as the operators say: texts without a letter
leave with the rejected ones, and one of repeated rows stays.

Learnt stages cannot be said in SQL, so ``ORACLE_SQL`` is None and the stages are tested
against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm import langid
from paystrata.llm.common import Scratch, documents, drop_table
from paystrata.llm.decontaminate import without_leaks
from paystrata.llm.neardup import one_of_each
from paystrata.llm.packing import pack_documents
from paystrata.llm.secrets import redact
from paystrata.llm.tokens import token_table
from paystrata.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE_WORDS = 5
#: Bytes of a batch between Spark and Python: the stages carry whole texts, and a task holds a
#: batch on both sides.
BATCH_BYTES = 4 << 20
_before: list[Scratch] = []


def fresh(spark: SparkSession) -> Scratch:
    """Intermediate tables of the stage that starts now; those of the stage before go."""
    while _before:
        _before.pop().drop_all()
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    _before.append(Scratch(spark))
    return _before[-1]


def named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string"),
                       F.col("source").cast("string"), F.col("n_chars").cast("bigint"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the rejected ones go."""
    fresh(spark)
    docs = named(docs)
    return langid.identify(docs, langid.fit(docs, F.lit(True)), COLUMNS).filter(~F.col("rejected")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(named(docs), SHINGLE_WORDS, fresh(spark)).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    fresh(spark)
    return without_leaks(named(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and their length renewed."""
    clean = redact(named(docs), fresh(spark))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of ids."""
    return pack_documents(fresh(spark).keep(token_table(named(docs)), "tokens"))


STAGES = [("language", language), ("near_duplicates", near_copies), ("decontamination", benchmark_leaks), ("secrets", secret_spans), ("packing", sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            drop_table(spark, last)
        last = path
    fresh(spark)
    return docs
