"""The given tables seen as transactions, star tables, events and metric samples.

Each view has a DuckDB twin in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.classify import classify_method
from paystrata.functions.parse import default_url, direction, rule_anomaly

METHOD_NAMES = {
    "1-URGENT": "PhonePe", "2-HIGH": "Bitcoin (BTC)", "3-MEDIUM": "NetBanking", "4-NOT SPECIFIED": "Skrill",
    "5-LOW": "Visa",
}
EVENT_TOPICS = {"view": "transactions", "click": "payments", "error": "complaints", "purchase": "reviews",
                "signup": "news"}
ANOMALY_LIMIT = 450000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_value(c: Column, mapping: dict[str, str]) -> Column:
    chain = None
    for key, value in mapping.items():
        chain = F.when(c == key, value) if chain is None else chain.when(c == key, value)
    return chain


def _status() -> Column:
    return (F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "P", "FAILED")
            .when(F.col("o_custkey") % 2 == 0, "SUCCESS").otherwise("PENDING"))


def _order_columns() -> dict[str, Column]:
    return {
        "ref_number": F.concat(F.lit("TXN_"), F.col("o_orderkey").cast("string")),
        "user_id": F.concat(F.lit("USR_"), F.col("o_custkey").cast("string")),
        "amount": F.col("o_totalprice"), "method": _by_value(F.col("o_orderpriority"), METHOD_NAMES),
        "type": direction("o_orderkey"), "status": _status(), "event_ts": F.col("o_orderdate"),
    }


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat transactions with the platform name."""
    orders = table(spark, sf_dir, "orders").withColumns(_order_columns())
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("platform_name"))
    return orders.join(customer, "o_custkey").join(nation, "c_nationkey").select(
        "ref_number", "user_id", "platform_name", "amount", "method", "type", "status", "event_ts", "o_orderkey")


def transactions_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("o_orderkey"), F.col("text").alias("raw_text"))
    return transactions(spark, sf_dir).join(documents, "o_orderkey", "left")


def platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations have transactions; regions are platforms without any."""
    nations = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("id"), F.col("n_name").alias("name"),
        (50.0 + (F.col("n_nationkey") * 7) % 50).alias("trust_score"))
    regions = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 101).cast("bigint").alias("id"), F.col("r_name").alias("name"),
        F.lit(None).cast("double").alias("trust_score"))
    return nations.unionByName(regions).withColumn("url", default_url("name"))


def methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return names.select(
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id"),
        _by_value(F.col("o_orderpriority"), METHOD_NAMES).alias("name"),
    ).withColumn("type", classify_method("name", "sink"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumns(_order_columns())
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return orders.join(customer, "o_custkey").select(
        (F.col("o_orderkey") + 1).alias("id"), "ref_number", "user_id",
        (F.col("c_nationkey") + 1).cast("bigint").alias("platform_id"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("method_id"), "amount", "type", "status",
        rule_anomaly("amount", ANOMALY_LIMIT).alias("is_anomalous"), F.col("event_ts").alias("datetime"))


def graph_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).withColumn("is_anomalous", rule_anomaly("amount", ANOMALY_LIMIT))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events in a disturbed arrival order (arr, event_id)."""
    e = table(spark, sf_dir, "events")
    delay = F.make_dt_interval(secs=(F.col("event_id") * 7919) % 1201)
    return e.select(
        "event_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.get_json_object("props", "$.k")).alias("ref_number"),
        F.col("event_type").alias("platform_name"), F.col("value").alias("amount"),
        F.col("ts").alias("event_ts"), (F.col("ts") + delay).alias("arr"))


def raw_events(spark: SparkSession, sf_dir: str, kind: str = "raw") -> DataFrame:
    """Wire events (all text) with injected faults, on topics by event type."""
    e = events(spark, sf_dir)
    every = lambda n: F.col("event_id") % n == 0
    return e.select(
        "event_id", "arr",
        F.concat(F.lit(f"payments.{kind}."), _by_value(F.col("platform_name"), EVENT_TOPICS)).alias("topic"),
        F.when(every(11), "").otherwise(F.col("ref_number")).alias("ref_number"),
        F.when(every(23), F.lit(None)).otherwise(F.col("platform_name")).alias("platform_name"),
        F.when(every(13), "0").when(every(17), "abc").otherwise(F.col("amount").cast("string")).alias("amount"),
        F.when(every(19), "not-a-time").otherwise(
            F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp"),
        F.lit(None).cast("string").alias("scrape_timestamp"),
        F.when(every(29), F.lit(None)).otherwise(F.lit("SUCCESS")).alias("status"),
        F.lit(None).cast("string").alias("method"),
        F.when(every(7), F.lit("Visa")).alias("method_name"), F.lit(None).cast("string").alias("type"))


def wire(events: DataFrame) -> DataFrame:
    """(topic, value) messages; every third one inside a ``data`` envelope."""
    body = F.struct("ref_number", "platform_name", "amount", "timestamp", "status", "method_name")
    return events.select(
        "topic", "event_id", "arr",
        F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.lit("s").alias("scraper"), body.alias("data"))))
        .otherwise(F.to_json(body)).alias("value"))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per event type, sampled each minute that has an event; an event
    stands for a thousand messages.

    Rows are folded to (series, minute) first, so what the counters run over is
    bounded by the minutes covered, not by the events.
    """
    from pyspark.sql import Window
    e = events(spark, sf_dir)
    minute = (F.floor(F.unix_seconds(F.col("event_ts").cast("timestamp")) / 60) * 60).cast("bigint")
    per_minute = e.groupBy(F.col("platform_name").alias("series"), minute.alias("t")).agg(
        (F.count(F.lit(1)) * 1000).alias("n"), (F.count_if(F.col("event_id") % 3 == 0) * 1000).alias("bad"),
        (F.count_if(F.col("event_id") % 5 == 0) * 1000).alias("dup"))
    w = Window.partitionBy("series").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return per_minute.select("series", "t", F.sum("n").over(w).alias("read"),
                             F.sum(F.col("n") - F.col("bad")).over(w).alias("processed"),
                             F.sum("bad").over(w).alias("rejected"), F.sum("dup").over(w).alias("duplicates"))
