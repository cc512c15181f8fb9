"""Explicit schemas: nothing in the library infers one from data."""

from pyspark.sql import types as T

_S, _D, _I, _L, _B, _TS = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Every wire field is text: numbers and times are parsed by the validators, so a
# malformed value reaches the dead-letter output instead of becoming null here.
EVENT_FIELDS = _struct(
    ref_number=_S, platform_name=_S, user_id=_S, amount=_S, method=_S, method_name=_S,
    type=_S, status=_S, timestamp=_S, scrape_timestamp=_S, raw_text=_S,
)
EVENT = T.StructType(EVENT_FIELDS.fields + [T.StructField("data", EVENT_FIELDS)])

BRONZE = T.StructType(
    EVENT_FIELDS.fields
    + _struct(year=_I, month=_I, day=_I, platform=_S).fields
)

SILVER = T.StructType(
    [T.StructField("ref_number", _S, False), T.StructField("user_id", _S),
     T.StructField("platform_name", _S, False)]
    + _struct(amount=_D, method=_S, type=_S, status=_S, event_ts=_TS, raw_text=_S, text_length=_I,
              has_upi=_I, has_bank=_I, has_crypto=_I, scraped_at=_TS).fields
)
SILVER_REPORT_COLUMNS = [
    "ref_number", "user_id", "platform_name", "amount", "method", "type", "status",
    "text_length", "has_upi", "has_bank", "has_crypto",
]

DLQ = _struct(failed_payload=_S, error=_S, failed_at=_TS, origin=_S)

TRANSACTION_DETAILS = _struct(
    upi_id=_S, upi_name=_S, bank_holder_name=_S, bank_account_number=_S, bank_ifsc_code=_S,
    bank_name=_S, crypto_id=_S, crypto_value=_S,
)
PAGE_RECORD = T.StructType(
    _struct(site_name=_S, payment_method=_S, start_url=_S, final_url=_S, html=_S, plain_text=_S,
            transaction_details=TRANSACTION_DETAILS, reference_urls=T.ArrayType(_S), fetchtime=_S,
            navigation_depth=_I, screenshots=T.MapType(_S, _S)).fields
)

ITEM = T.StructType(
    [T.StructField("kind", _S)] + EVENT_FIELDS.fields
    + _struct(data_quality=_S, _pushed=_B).fields
)

METRIC_SAMPLE = _struct(name=_S, labels=T.MapType(_S, _S), value=_D, ts=_TS)
VECTOR_RECORD = _struct(id=_S, source=_S, content=_S, vector=T.ArrayType(T.FloatType()))

PLATFORMS = _struct(id=_L, name=_S, url=_S, description=_S, trust_score=_D, risk_score=_D, created_at=_TS)
PAYMENT_METHODS = _struct(id=_L, name=_S, type=_S, reliability_score=_D, created_at=_TS)
TRANSACTIONS = _struct(id=_L, ref_number=_S, user_id=_S, platform_id=_L, method_id=_L, amount=_D,
                       type=_S, status=_S, is_anomalous=_B, datetime=_TS)
