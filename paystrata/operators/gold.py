"""Silver enrichment and the two Gold aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.parse import parse_ts, payment_flags, text_length, to_amount
from paystrata.operators.dedup import dedup_first
from paystrata.operators.validate import require_not_null
from paystrata.schemas import SILVER_REPORT_COLUMNS

REQUIRED = ["ref_number", "platform_name", "amount"]


def enrich(df: DataFrame, extended_flags: bool = False) -> DataFrame:
    """Typed amount and event time, text length and markers."""
    if "event_ts" not in df.columns:
        df = df.withColumn("event_ts", parse_ts("timestamp"))
    return df.withColumns({
        "amount": to_amount("amount"), "text_length": text_length("raw_text"),
        **payment_flags("raw_text", extended_flags)})


def to_silver(raw: DataFrame, order: list[Column], extended_flags: bool = False) -> DataFrame:
    """Bronze rows to Silver: required fields, first row per reference, enrichment.

    Enrichment comes first: it reduces the text to four numbers, so the shuffle of
    the deduplication need not carry the text unless the caller keeps it.
    """
    return dedup_first(enrich(require_not_null(raw, REQUIRED), extended_flags), ["ref_number"], order)


def select_silver(df: DataFrame) -> DataFrame:
    return df.select(*SILVER_REPORT_COLUMNS)


def gold_payment_channels(silver: DataFrame) -> DataFrame:
    """Volume and count per method; rows without a method form their own group."""
    return silver.groupBy("method").agg(
        F.sum("amount").alias("volume"), F.count("ref_number").alias("total_transactions"))


def gold_platform_metrics(silver: DataFrame) -> DataFrame:
    """Count, success rate, mean amount and 80/20 risk per platform."""
    success = F.when(F.col("status") == "SUCCESS", 1.0).otherwise(0.0)
    return silver.groupBy("platform_name").agg(
        F.count("ref_number").alias("transaction_count"), F.avg(success).alias("success_rate"),
        F.avg("amount").alias("avg_amount"),
    ).withColumn("risk_score", F.when(F.col("success_rate") < 0.5, 80.0).otherwise(20.0))


# ------------------------------------------------------------ Gold kept by deltas

#: Exact, so rows that are taken back leave nothing behind; what does not fit is kept apart.
_EXACT = "decimal(30,8)"
_SUMS = ["rows", "refs", "success", "amounts", "total", "others", "rest"]


def gold_parts(silver: DataFrame) -> DataFrame:
    """Sums by platform and method from which both Gold tables follow, and which add up."""
    exact = F.col("amount").try_cast(_EXACT)
    other = F.col("amount").isNotNull() & exact.isNull()
    return silver.groupBy("platform_name", "method").agg(
        F.count(F.lit(1)).alias("rows"), F.count("ref_number").alias("refs"), F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count("amount").alias("amounts"), F.coalesce(F.sum(exact), F.lit(0)).cast("decimal(38,8)").alias("total"),
        F.count_if(other).alias("others"), F.coalesce(F.sum(F.when(other, F.col("amount"))), F.lit(0.0)).alias("rest"))


def add_parts(before: DataFrame, came: DataFrame, went: DataFrame) -> DataFrame:
    """The parts after rows came and others went; groups without rows are gone."""
    back = went.select("platform_name", "method", *[(-F.col(c)).cast(k).alias(c) for c, k in went.dtypes if c in _SUMS])
    added = before.unionByName(came).unionByName(back).groupBy("platform_name", "method").agg(
        *[F.sum(c).cast(dict(before.dtypes)[c]).alias(c) for c in _SUMS])
    return added.filter("rows > 0").withColumn("rest", F.when(F.col("others") > 0, F.col("rest")).otherwise(0.0))


def channels_from(parts: DataFrame) -> DataFrame:
    volume = F.sum("total").cast("double") + F.sum("rest")
    return parts.groupBy("method").agg(F.when(F.sum("amounts") > 0, volume).alias("volume"), F.sum("refs").alias("total_transactions"))


def platforms_from(parts: DataFrame) -> DataFrame:
    return parts.groupBy("platform_name").agg(
        F.sum("refs").alias("transaction_count"), (F.sum("success") / F.sum("rows")).alias("success_rate"),
    ).withColumn("risk_score", F.when(F.col("success_rate") < 0.5, 80.0).otherwise(20.0))


def high_risk(gold: DataFrame, limit: float = 50.0) -> DataFrame:
    return gold.filter(F.col("risk_score") > limit)
