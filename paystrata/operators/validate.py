"""Row validation. Each function adds an ``error`` column: null means valid."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.parse import first_truthy, is_blank, parse_ts, to_amount

# Reason texts.
MISSING_STREAM = "Schema validation failed: missing ref_number, platform_name, amount, or timestamp"
MISSING_PLATFORM_STREAM = "Schema validation failed: missing platform_name"
NOT_POSITIVE = "Validation failed: transaction amount must be positive"
NOT_NUMERIC = "Validation failed: amount must be numeric"
BAD_TIMESTAMP = "Validation failed: invalid timestamp ISO format"
LATE = "Late event arrived after watermark. Event Time: "
MISSING_PLATFORM_LANDING = "Validation failed: missing platform_name"
MISSING_LANDING = "Validation failed: missing required transactional fields: "
NOT_A_NUMBER_LANDING = "Validation failed: amount must be a number. Amount: "
NOT_POSITIVE_LANDING = "Validation failed: transaction amount must be positive. Amount: "
METADATA_KINDS = ["payments", "reviews", "complaints", "news"]
UNSTORED_QUALITY = ["NOT_SCRAPED", "SCRAPE_FAILED"]
GENERIC_NAMES = ["deposit", "withdraw", "payment", "method", "more", "show"]


def require_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    for name in cols:
        df = df.filter(F.col(name).isNotNull())
    return df


def event_text() -> Column:
    return first_truthy("timestamp", "scrape_timestamp")


def _amount_error(not_numeric: Column, not_positive: Column) -> Column:
    value = to_amount("amount")
    return F.when(value.isNull(), not_numeric).when(value <= 0, not_positive)


def validate_transactions(df: DataFrame) -> DataFrame:
    """Stream rules in order: missing field, amount, timestamp. The late rule
    needs the running maximum and follows in the lateness operator."""
    missing = (is_blank("ref_number") | is_blank("platform_name") | is_blank(event_text())
               | F.col("amount").isNull())
    error = F.coalesce(
        F.when(missing, F.lit(MISSING_STREAM)),
        _amount_error(F.lit(NOT_NUMERIC), F.lit(NOT_POSITIVE)),
        F.when(parse_ts(event_text()).isNull(), F.lit(BAD_TIMESTAMP)),
    )
    return df.withColumn("error", error)


def validate_metadata(df: DataFrame) -> DataFrame:
    return df.withColumn("error", F.when(is_blank("platform_name"), F.lit(MISSING_PLATFORM_STREAM)))


def is_metadata(topic: Column | str) -> Column:
    name = F.col(topic) if isinstance(topic, str) else topic
    return F.substring_index(name, ".", -1).isin(METADATA_KINDS)


def validate_landing(df: DataFrame) -> DataFrame:
    """Landing rules; the amount reasons stay distinct (one row, one reason).

    Adds ``error`` with the text and ``reason`` with the counter label.
    """
    metadata = is_metadata("topic")
    tests = {
        "ref_number": is_blank("ref_number"), "platform_name": is_blank("platform_name"),
        "timestamp": is_blank(event_text()), "amount": F.col("amount").isNull(), "status": is_blank("status"),
    }
    missing = F.filter(
        F.array(*[F.when(test, F.lit(f"'{name}'")) for name, test in tests.items()]), lambda x: x.isNotNull())
    lacks = F.size(missing) > 0
    value = to_amount("amount")
    reason = (
        F.when(metadata & is_blank("platform_name"), "missing_platform")
        .when(metadata, F.lit(None))
        .when(lacks, "missing_fields")
        .when(value.isNull(), "non_numeric_amount")
        .when(value <= 0, "invalid_amount")
    )
    amount_text = F.col("amount").cast("string")
    text = (
        F.when(F.col("reason") == "missing_platform", F.lit(MISSING_PLATFORM_LANDING))
        .when(F.col("reason") == "missing_fields",
              F.concat(F.lit(MISSING_LANDING + "["), F.array_join(missing, ", "), F.lit("]")))
        .when(F.col("reason") == "non_numeric_amount", F.concat(F.lit(NOT_A_NUMBER_LANDING), amount_text))
        .when(F.col("reason") == "invalid_amount", F.concat(F.lit(NOT_POSITIVE_LANDING), amount_text))
    )
    return df.withColumn("reason", reason).withColumn("error", text)


def validate_items(df: DataFrame) -> DataFrame:
    """Item rules by ``kind``: transactions strict, payment methods need both names."""
    value = to_amount("amount")
    missing_tx = is_blank("ref_number") | is_blank("platform_name") | F.col("amount").isNull()
    transaction = (
        F.when(missing_tx, "TransactionItem missing required fields")
        .when(value.isNull(), F.concat(F.lit("Amount not a number: "), F.col("amount")))
        .when(value <= 0, F.concat(F.lit("Amount must be positive: "), F.col("amount")))
    )
    method = F.when(is_blank("platform_name") | is_blank("method_name"),
                    "PaymentMethodItem missing platform_name or method_name")
    return df.withColumn(
        "error", F.when(F.col("kind") == "transaction", transaction)
        .when(F.col("kind") == "payment_method", method))


def split_valid(df: DataFrame, origin: str | None = None, failed_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead letters). The whole failed row is kept as JSON text."""
    payload_columns = [c for c in df.columns if c not in ("error", "reason", "payload")]
    payload = F.col("payload") if "payload" in df.columns else F.to_json(F.struct(*payload_columns))
    valid = df.filter(F.col("error").isNull()).drop("error", "reason")
    dead = df.filter(F.col("error").isNotNull()).select(
        payload.alias("failed_payload"), "error",
        (failed_at if failed_at is not None else F.current_timestamp()).alias("failed_at"),
        F.lit(origin).cast("string").alias("origin"))
    return valid, dead


def route(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(transactions, metadata); metadata skips the window and goes to the clean topic."""
    metadata = df.filter(is_metadata("topic")).withColumn(
        "topic", F.replace(F.col("topic"), F.lit(".raw."), F.lit(".clean.")))
    return df.filter(~is_metadata("topic")), metadata


def storable(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("data_quality"), F.lit("")).isin(UNSTORED_QUALITY))


def not_pushed(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("_pushed"), F.lit(False)))


def clean_method_names(df: DataFrame, name_col: str = "name", extra: Iterable[str] = ()) -> DataFrame:
    """Drop empty, one-letter and generic names of a listing."""
    name = F.trim(F.col(name_col))
    return df.filter((F.length(name) >= 2) & ~F.lower(name).isin(GENERIC_NAMES + list(extra)))
