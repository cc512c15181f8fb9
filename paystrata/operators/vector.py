"""Text encoding, the vector table, and exact nearest-neighbour search."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.functions.parse import _col
from paystrata.operators.dedup import top_per_group
from paystrata.operators.nearest import BLOCK_BYTES, Cells

# Fixed values.
DIMENSION = 384
SEED_MODULUS = 65535
DEFAULT_THRESHOLD = 1.5
CONTEXT_THRESHOLD = 1.8
LAYER_FAQ = [
    ("faq_2", "FAQ", "Bronze layer stores raw unvalidated JSON payloads directly emitted from scrapy producers."),
    ("faq_3", "FAQ", "Silver layer contains deduplicated, cleaned, and type-validated relational schemas inside "
                     "PostgreSQL."),
    ("faq_4", "FAQ", "Gold layer aggregates transaction metrics like payment channel success rates and user "
                     "profit-loss indicators."),
    ("faq_5", "FAQ", "Isolation Forest ML model is configured with a 3% contamination factor to detect extreme "
                     "transaction amount anomalies."),
]


def _seeds(texts: pd.Series) -> pd.Series:
    def total(text: str | None) -> int:
        points = np.frombuffer(("None" if text is None else text).encode("utf-32-le"), dtype="<u4")
        return int(points.sum(dtype="int64")) % SEED_MODULUS
    return texts.map(total).astype("int64")


def text_seed(c: Column | str) -> Column:
    """Sum of the code points modulo the seed space, over the whole text."""
    return F.pandas_udf(_seeds, "bigint")(_col(c))


def unit_normals(seed: int, dim: int = DIMENSION, generator: np.random.RandomState | None = None) -> np.ndarray:
    """``generator`` is seeded anew; making one costs twenty times what a draw does."""
    generator = generator or np.random.RandomState()
    generator.seed(seed)
    vector = generator.randn(dim)
    norm = np.linalg.norm(vector)
    return (vector / norm if norm > 0 else vector).astype("float32")


def encode(c: Column | str, dim: int = DIMENSION,
           model: Callable[[pd.Series], pd.Series] | None = None) -> Column:
    """Vector of a text. ``model`` is where a real encoder plugs in (texts to lists);
    without one, equal texts get equal unit vectors from a seeded generator."""
    if model is not None:
        return F.pandas_udf(model, T.ArrayType(T.FloatType()))(_col(c))

    def from_text(texts: pa.Array) -> pa.Array:
        # Lists are made from one buffer: a Python list per row costs many times what drawing does.
        seeds, of = np.unique(_seeds(pd.Series(texts.to_pylist(), dtype="object")).to_numpy(), return_inverse=True)
        generator = np.random.RandomState()
        drawn = np.array([unit_normals(int(s), dim, generator) for s in seeds], dtype="float32").reshape(-1, dim)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(of) + 1) * dim, pa.int32()), pa.array(drawn[of].ravel()))

    return F.arrow_udf(from_text, T.ArrayType(T.FloatType()))(_col(c))


def spread(records: DataFrame) -> DataFrame:
    """The same rows dealt evenly over all cores: encoding makes many times the bytes by which Spark sized the partitions."""
    spark = records.sparkSession
    return records.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def encode_records(records: DataFrame, text: str = "content", dim: int = DIMENSION) -> DataFrame:
    return records.withColumn("vector", encode(text, dim))


def faq_records(spark) -> DataFrame:
    return spark.createDataFrame(LAYER_FAQ, "id string, source string, content string")


def number_text(c: Column | str) -> Column:
    """Plain decimal text of a double, at least one decimal, never an exponent."""
    fixed = F.regexp_replace(F.format_string("%.6f", _col(c)), r"0+$", "")
    return F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)


def transaction_records(silver: DataFrame) -> DataFrame:
    """One sentence per transaction."""
    return silver.select(
        F.concat(F.lit("tx_"), "ref_number").alias("id"), F.lit("silver_transactions").alias("source"),
        F.concat(F.lit("Transaction reference "), "ref_number", F.lit(" processed "), number_text("amount"),
                 F.lit(" INR via "), "method", F.lit(" on platform "), "platform_name", F.lit(" with status "),
                 "status", F.lit(".")).alias("content"))


def platform_records(gold: DataFrame) -> DataFrame:
    return gold.select(
        F.concat(F.lit("platform_"), "platform_name").alias("id"), F.lit("gold_platform_metrics").alias("source"),
        F.concat(F.lit("Platform "), "platform_name", F.lit(" has processed "),
                 F.col("transaction_count").cast("string"), F.lit(" transactions with a success rate of "),
                 F.format_string("%.2f", F.col("success_rate")), F.lit(" and risk score of "),
                 number_text("risk_score"), F.lit(".")).alias("content"))


def index_records(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def new_records(records: DataFrame, index: DataFrame) -> DataFrame:
    """Records whose id is not in the index; repeats inside ``records`` count once."""
    w = top_per_group(records, ["id"], [F.col("source"), F.col("content")], 1).drop("rank")
    return w.join(index.select("id"), "id", "left_anti")


def write_index(index: DataFrame, path: str) -> None:
    """One table holds id, source, content and vector, so they cannot disagree."""
    index.write.mode("append").parquet(path)


def read_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def index_stats(index: DataFrame) -> DataFrame:
    return index.agg(
        F.count(F.lit(1)).alias("total_vectors"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dimension"),
    ).withColumn("healthy", F.col("total_vectors") > 0)


def similarity_search(
    index: DataFrame, queries: DataFrame, k: int = 3, threshold: float = DEFAULT_THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, id, distance, rank): exact squared-L2 top ``k``, then the threshold.

    ``index`` has (id, vector), ``queries`` has (query_id, vector). Both are written once;
    cells that no answer can be in are left out (``nearest``). No vector but a bounded sample
    passes through the driver, and no task holds more than two tiles of ``block_bytes``.
    """
    hits = Cells(index, block_bytes).search(queries, k, threshold)[0]
    return hits.select("query_id", F.col("id").cast(index.schema["id"].dataType), "distance", F.col("rank").cast("int"))


def retrieve_context(index: DataFrame, queries: DataFrame, k: int = 3,
                     threshold: float = CONTEXT_THRESHOLD) -> DataFrame:
    """Hits with their source and content, for the grounding operators."""
    hits = similarity_search(index, queries, k, threshold)
    return hits.join(index.select("id", "source", "content"), "id")
