"""Scalar column functions: casts, defaults, keys, references, payload strings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
NOT_COLLECTED = "Not Yet Collected"
URI_PARAMETERS = {
    "pa": "upi_id", "pn": "upi_name", "am": "amount", "tr": "transaction_reference",
    "cu": "currency", "tn": "note",
}
CRYPTO_TOKEN_PATTERN = r"\b(bc1|[13])[a-zA-Z0-9]{25,50}\b"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_amount(c: Column | str) -> Column:
    """Text to double; null when it is no number (a plain cast would fail the job)."""
    return F.trim(_col(c).cast("string")).try_cast("double")


def parse_ts(c: Column | str, default: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, then ISO-8601, then ``default``.

    The date prefix is required: without it the ISO reader also takes ``2024``.
    """
    text = _col(c)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
    tries = [F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), iso]
    return F.coalesce(*tries, *([default] if default is not None else []))


def first_truthy(*cols: Column | str) -> Column:
    """First value that is neither null nor empty, else the last one."""
    *head, last = [_col(c) for c in cols]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in head], last)


def is_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit("")) == ""


def text_length(c: Column | str) -> Column:
    return F.coalesce(F.length(_col(c)), F.lit(0))


def payment_flags(c: Column | str, extended: bool = False) -> dict[str, Column]:
    """0/1 markers for handles, bank codes and wallet addresses in a text."""
    text = _col(c)
    bank, crypto = text.contains("IFSC"), text.contains("0x")
    if extended:
        bank = bank | text.contains("Account")
        crypto = crypto | text.rlike(CRYPTO_TOKEN_PATTERN)
    tests = {"has_upi": text.contains("@"), "has_bank": bank, "has_crypto": crypto}
    return {name: F.when(test, 1).otherwise(0) for name, test in tests.items()}


def slug(c: Column | str) -> Column:
    """Partition-safe platform key."""
    return F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit("UNKNOWN"))), r"[^a-zA-Z0-9_]", "_")


def safe_name(c: Column | str) -> Column:
    """File-name-safe text; letters of every script are kept."""
    return F.regexp_replace(_col(c), r"(?U)[^\w\-.]", "_")


def default_url(c: Column | str) -> Column:
    return F.concat(F.lit("https://"), F.lower(F.replace(_col(c), F.lit(" "), F.lit(""))), F.lit(".com"))


def canonical_platform(c: Column | str) -> Column:
    name = F.trim(_col(c))
    return F.when(F.lower(name) == "1xbet", F.lit("1xBet")).otherwise(name)


def flag_if(c: Column | str, value: str) -> Column:
    """1.0 when the text equals ``value`` in any case, else 0.0."""
    return F.when(F.upper(_col(c)) == value, 1.0).otherwise(0.0)


def rule_anomaly(amount: Column | str, limit: float = 45000.0) -> Column:
    return F.coalesce(_col(amount) > limit, F.lit(False))


def extract_min_amount(c: Column | str) -> Column:
    """``Min: 500`` or ``Minimum: 500`` in a page text; null when absent."""
    return F.nullif(F.regexp_extract(_col(c), r"(?i)Min(imum)?:\s*(\d+)", 2), F.lit("")).try_cast("double")


def extract_account(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), r"(?i)Account\s+(\d+)", 1), F.lit(""))


def make_ref(index: Column | str, ts: Column | str) -> Column:
    """``REF_SCR_007_093015``: at least three digits, then the time of day."""
    number = _col(index).cast("string")
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    return F.concat_ws("_", F.lit("REF_SCR"), padded, F.date_format(_col(ts), "HHmmss"))


def direction(index: Column | str) -> Column:
    return F.when(_col(index) % 4 != 0, "DEPOSIT").otherwise("WITHDRAWAL")


def parse_payment_uri(c: Column | str) -> Column:
    """Struct of the parameters of ``upi://…``; any other text is a wallet token."""
    text = _col(c)
    is_uri = text.startswith("upi://")
    fields = [
        F.when(is_uri, F.coalesce(
            F.try_url_decode(F.try_parse_url(text, F.lit("QUERY"), F.lit(key))), F.lit(""))).alias(name)
        for key, name in URI_PARAMETERS.items()
    ]
    token = F.when(~is_uri, text).alias("crypto_token")
    return F.struct(*fields, token)


def parse_details(c: Column | str, schema: str) -> Column:
    """Struct from JSON or from a single-quoted dictionary text."""
    return F.from_json(_col(c), schema, {"allowSingleQuotes": "true"})


def conform(df: DataFrame, columns: Iterable[str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly ``columns``, absent ones filled: 0 for numbers named so, else UNKNOWN."""
    fill = {"amount": 0.0, "text_length": 0, **(defaults or {})}
    wanted = list(columns)
    absent = {name: F.lit(fill.get(name, "UNKNOWN")) for name in wanted if name not in df.columns}
    return df.withColumns(absent).select(*wanted) if absent else df.select(*wanted)
