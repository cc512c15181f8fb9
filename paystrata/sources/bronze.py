"""Raw event sources, the Bronze layout, and JSON sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paystrata.functions.parse import slug
from paystrata.schemas import BRONZE, EVENT

PARTITIONS = ["year", "month", "day", "platform"]
RAW_PREFIX = "payments.raw."
# Topic suffix by item kind.
ITEM_TOPICS = {
    "payment_method": "payments", "transaction": "transactions", "review": "reviews",
    "complaint": "complaints", "news": "news",
}


def read_events(spark: SparkSession, fmt: str, options: dict[str, str], topics: list[str]) -> DataFrame:
    """Stream of (topic, value, partition, offset, appended) from a log or from a folder.

    ``appended`` is when the log took the record: offsets order one partition alone, the
    append time orders all of them. A log starts at its earliest offset. A folder holds
    the same columns, so the path after this function is the same for both.
    """
    if fmt == "kafka":
        raw = (spark.readStream.format("kafka").option("subscribe", ",".join(topics))
               .option("startingOffsets", "earliest").options(**options).load())
        return raw.select("topic", F.col("value").cast("string").alias("value"), "partition", "offset",
                          F.col("timestamp").alias("appended"))
    raw = (spark.readStream.format(fmt).schema("topic string, value string, partition int, offset bigint, appended timestamp")
           .options(**options).load())
    return raw.filter(F.col("topic").isin(topics))


def parse_payload(df: DataFrame, schema: StructType = EVENT, value: str = "value") -> DataFrame:
    """JSON text to columns. A ``data`` envelope replaces the outer fields (no merge);
    text that is no JSON object leaves every field null and fails validation."""
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE"})
    inner = [f.name for f in schema.fields if f.name != "data"]
    has_envelope = F.col("__p.data").isNotNull()
    picked = {n: F.when(has_envelope, F.col(f"__p.data.{n}")).otherwise(F.col(f"__p.{n}")) for n in inner}
    return df.withColumn("__p", parsed).withColumns(picked).withColumnRenamed(value, "payload").drop("__p")


def with_partitions(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Partition columns from the ingest time (not the event time) and the platform."""
    at = ingested_at if ingested_at is not None else F.current_timestamp()
    return df.withColumns({
        "year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd"),
        "platform": slug("platform_name")})


def write_bronze(df: DataFrame, path: str, ingested_at: Column | None = None, mode: str = "append") -> None:
    """One JSON object per line under year/month/day/platform.

    The rebalance hint splits a partition that outgrows the advisory size and
    merges small ones, so a platform with a third of the rows gets many writers.
    """
    (with_partitions(df, ingested_at).hint("rebalance", *PARTITIONS)
     .write.mode(mode).partitionBy(*PARTITIONS).json(path))


def read_bronze(spark: SparkSession, path: str, schema: StructType = BRONZE, multiline: bool = False) -> DataFrame:
    """Explicit schema, so there is no inference pass; filters on the partition
    columns prune folders. ``multiline`` reads files that hold one indented object."""
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("multiLine", str(multiline).lower()).json(path))


def topic_of(kind: Column | str, prefix: str = RAW_PREFIX) -> Column:
    c = F.col(kind) if isinstance(kind, str) else kind
    chain = None
    for name, suffix in ITEM_TOPICS.items():
        chain = F.when(c == name, suffix) if chain is None else chain.when(c == name, suffix)
    return F.concat(F.lit(prefix), chain.otherwise(F.lower(c)))


def publishable(df: DataFrame, topic: Column, published_at: Column | None = None) -> DataFrame:
    """(topic, value) rows. Metadata and timestamp are added only where unset."""
    at = published_at if published_at is not None else F.current_timestamp()
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    defaults = {"timestamp": stamp, "_kafka_topic": topic, "_published_at": stamp}
    filled = {c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in defaults.items()}
    body = [c for c in df.columns if c not in (*filled, "topic", "error")]
    return df.withColumns(filled).select(
        topic.alias("topic"), F.to_json(F.struct(*body, *filled)).alias("value"))


def publish(df: DataFrame, topic: Column, path: str | None = None, kafka: dict[str, str] | None = None) -> None:
    """Batch publish to a log or to a folder (the body of a ``foreachBatch``)."""
    rows = publishable(df, topic)
    if kafka:
        rows.write.format("kafka").options(**kafka).save()
    else:
        rows.write.mode("append").json(path)


def export_json(df: DataFrame, path: str, exported_at: Column | None = None) -> None:
    at = exported_at if exported_at is not None else F.current_timestamp()
    df.withColumn("export_timestamp", at).write.mode("append").json(path)


def write_dlq(dead: DataFrame, path: str) -> None:
    dead.write.mode("append").json(path)
