"""Reports over the star tables: platforms, payment_methods, transactions.

Facts are aggregated by id before they meet a dimension, so the joins work on one
row per id and a platform with a third of the rows is folded on the map side.
Dimension joins carry no hint: Spark broadcasts a side whose size it knows to be
small and otherwise merges, where adaptive execution splits a skewed partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paystrata.operators.dedup import top_per_group

RECENT_EVENT = "TRANSACTION"


def _sum_if(test: Column, value: str = "amount") -> Column:
    return F.sum(F.when(test, F.col(value)).otherwise(0.0))


def _money(c: str) -> Column:
    return F.round(F.coalesce(F.col(c), F.lit(0.0)), 2)


def _fact_aggregates() -> list[Column]:
    deposit, withdrawal = F.col("type") == "DEPOSIT", F.col("type") == "WITHDRAWAL"
    return [
        F.count("id").alias("transaction_count"),
        _sum_if(deposit).alias("deposit_volume"), _sum_if(withdrawal).alias("withdrawal_volume"),
        F.count_if("is_anomalous").alias("anomaly_count"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"),
        F.count_if(F.col("status") == "FAILED").alias("failed_count"),
        F.min("datetime").alias("first_transaction"), F.max("datetime").alias("last_transaction"),
    ]


def platform_breakdown(platforms: DataFrame, tx: DataFrame) -> DataFrame:
    """One row per platform, with or without transactions."""
    folded = tx.groupBy(F.col("platform_id").alias("id")).agg(*_fact_aggregates())
    counts = ["transaction_count", "anomaly_count", "success_count", "failed_count"]
    return (
        platforms.select("id", "name", "url").join(folded, "id", "left")
        .withColumns({
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in counts},
            "deposit_volume": _money("deposit_volume"), "withdrawal_volume": _money("withdrawal_volume")})
        .withColumn("scan_status", F.when(F.col("transaction_count") > 0, "DATA_AVAILABLE").otherwise("NO_DATA"))
        .orderBy(F.desc("transaction_count"), "id"))


def star_rows(tx: DataFrame, platforms: DataFrame, methods: DataFrame) -> DataFrame:
    """Fact rows with the names, url and method type of both dimensions (inner)."""
    p = platforms.select(F.col("id").alias("platform_id"), F.col("name").alias("platform_name"),
                         F.col("url").alias("platform_url"))
    m = methods.select(F.col("id").alias("method_id"), F.col("name").alias("method_name"),
                       F.col("type").alias("method_type"))
    return tx.join(p, "platform_id").join(m, "method_id")


def transactions_by_platform(
    tx: DataFrame, platforms: DataFrame, methods: DataFrame, platform_id: int | None = None,
) -> DataFrame:
    """Transactions of one platform (or of each), newest first."""
    if platform_id is not None:
        tx = tx.filter(F.col("platform_id") == platform_id)
    rows = star_rows(tx, platforms, methods).select(
        "id", "ref_number", "user_id", "amount", "type", "status", "is_anomalous", "datetime",
        "platform_name", "platform_url", "method_name", "method_type")
    order = [F.desc("datetime"), F.col("id")]
    return rows.orderBy(*order) if platform_id is not None else rows.orderBy("platform_name", *order)


def overview_totals(
    platforms: DataFrame, methods: DataFrame, tx: DataFrame, reviews: DataFrame, complaints: DataFrame,
    news: DataFrame,
) -> DataFrame:
    """Eleven counts as (metric, value): one pass over each table."""
    facts = tx.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(F.col("type") == "DEPOSIT").alias("deposits"),
        F.count_if(F.col("type") == "WITHDRAWAL").alias("withdrawals"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_transactions"),
        F.count_if(F.col("status") == "FAILED").alias("failed_transactions"),
        F.count_if("is_anomalous").alias("anomalous_transactions"))
    totals = facts.unpivot([], facts.columns, "metric", "value")
    others = {"platforms": platforms, "payment_methods": methods, "reviews": reviews,
              "complaints": complaints, "news_articles": news}
    for metric, df in others.items():
        totals = totals.unionByName(
            df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(metric).alias("metric"), "value"))
    return totals


def kpi_snapshot(totals: DataFrame) -> DataFrame:
    """The three dashboard counts out of ``overview_totals``."""
    names = {"platforms": "active_platforms", "transactions": "ingested_transactions",
             "anomalous_transactions": "flagged_fraud_alerts"}
    renamed = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("metric"))
    return totals.filter(F.col("metric").isin(list(names))).select(renamed.alias("metric"), "value")


def kpi_ratios(tx: DataFrame) -> DataFrame:
    """Anomaly and success percentage of all transactions, one decimal."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    return tx.agg(
        F.round(F.count_if("is_anomalous") / n * 100, 1).alias("anomaly_pct"),
        F.round(F.count_if(F.col("status") == "SUCCESS") / n * 100, 1).alias("success_pct"))


def methods_by_type(methods: DataFrame) -> DataFrame:
    """Method count per type with its share of all methods (whole percent)."""
    counts = methods.groupBy("type").agg(F.count(F.lit(1)).alias("count"))
    # One row per type, so the total is a window over a handful of rows.
    share = F.round(F.col("count") / F.sum("count").over(Window.partitionBy(F.lit(0))) * 100)
    return counts.withColumn("share_pct", share.cast("int")).orderBy(F.desc("count"), "type")


def _usage(tx: DataFrame, keys: list[str]) -> DataFrame:
    return tx.groupBy(*keys).agg(
        F.count("id").alias("transaction_count"),
        _sum_if(F.col("type") == "DEPOSIT").alias("deposit_volume"),
        _sum_if(F.col("type") == "WITHDRAWAL").alias("withdrawal_volume"))


def _method_columns(methods: DataFrame) -> DataFrame:
    return methods.select(F.col("id").alias("method_id"), "name", F.col("type").alias("method_type"))


def top_methods(tx: DataFrame, methods: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most used methods, with the bar length relative to the first."""
    used = tx.groupBy("method_id").agg(F.count("id").alias("transaction_count"))
    top = (used.join(_method_columns(methods), "method_id")
           .groupBy("name", "method_type").agg(F.sum("transaction_count").alias("transaction_count"))
           .orderBy(F.desc("transaction_count"), "name").limit(k))
    longest = F.max("transaction_count").over(Window.partitionBy(F.lit(0)))
    return top.withColumn("bar_pct", F.round(F.col("transaction_count") / F.greatest(longest, F.lit(1)) * 100, 1))


def platform_method_usage(tx: DataFrame, methods: DataFrame, platform_id: int | None = None) -> DataFrame:
    """Usage of each method per platform."""
    if platform_id is not None:
        tx = tx.filter(F.col("platform_id") == platform_id)
    return (_usage(tx, ["platform_id", "method_id"]).join(_method_columns(methods), "method_id")
            .withColumns({"deposit_volume": _money("deposit_volume"),
                          "withdrawal_volume": _money("withdrawal_volume")})
            .orderBy("platform_id", F.desc("transaction_count"), "method_id"))


def platform_summary(tx: DataFrame, platforms: DataFrame) -> DataFrame:
    """Transaction totals per platform, zero where there are none."""
    folded = tx.groupBy(F.col("platform_id").alias("id")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("type") == "DEPOSIT").alias("deposits"),
        F.count_if(F.col("type") == "WITHDRAWAL").alias("withdrawals"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if("is_anomalous").alias("anomalies"),
        F.sum("amount").alias("total_volume"))
    counts = ["total", "deposits", "withdrawals", "successful", "failed", "anomalies"]
    return platforms.select("id").join(folded, "id", "left").withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in counts}, "total_volume": _money("total_volume")})


def platform_card(usage: DataFrame, shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """(methods per type, the most used methods with the number not shown)."""
    by_type = usage.groupBy("platform_id", "method_type").agg(F.count(F.lit(1)).alias("methods"))
    sizes = usage.groupBy("platform_id").agg(
        F.greatest(F.count(F.lit(1)) - shown, F.lit(0)).alias("more_methods"))
    top = top_per_group(usage, ["platform_id"], [F.desc("transaction_count"), F.col("name")], shown)
    return by_type, top.select("platform_id", "rank", "name", "method_type", "transaction_count").join(
        sizes, "platform_id")


def recent_activity(tx: DataFrame, platforms: DataFrame, methods: DataFrame, rows: int = 5, k: int = 10) -> DataFrame:
    """The newest transactions as feed entries."""
    newest = star_rows(tx, platforms, methods).orderBy(F.desc("datetime"), F.desc("id")).limit(rows)
    return newest.select(
        F.lit(RECENT_EVENT).alias("type"), "id", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("platform_name").alias("platform"),
        F.concat(F.col("type"), F.lit(" via "), F.col("method_name"), F.lit(" — Status: "), F.col("status"))
        .alias("description"),
        F.lit("REAL").alias("data_quality"),
    ).orderBy(F.desc("timestamp"), F.desc("id")).limit(k)


def lookup(df: DataFrame, predicate: Column | None = None, key: str = "id", skip: int = 0, limit: int = 100) -> DataFrame:
    """One page of the matching rows in key order (all lookups by id, name or reference)."""
    rows = df.filter(predicate) if predicate is not None else df
    return rows.orderBy(key).offset(skip).limit(limit)


def page_after(
    df: DataFrame, keys: list[str], after: tuple | None = None, limit: int = 100, predicate: Column | None = None,
) -> DataFrame:
    """The page behind the row whose keys are ``after``, in ascending key order; the first page without it.

    A deep page costs what the first one does: the keys are compared in the scan, and every task
    keeps ``limit`` rows, where an offset keeps all that it skips. ``keys`` must tell rows apart,
    or rows equal to the last one of a page are passed over; a null key comes first.
    """
    if after is not None:
        behind = F.lit(False)
        for key, value in reversed(list(zip(keys, after, strict=True))):
            more = F.col(key).isNotNull() if value is None else F.col(key) > F.lit(value)
            behind = more | (F.col(key).eqNullSafe(F.lit(value)) & behind)
        df = df.filter(behind)
    rows = df.filter(predicate) if predicate is not None else df
    return rows.orderBy(*keys).limit(limit)


def last_key(page: DataFrame, keys: list[str]) -> tuple | None:
    """Where the next page starts; none behind an empty page. One row comes to the driver."""
    row = page.orderBy(*[F.desc_nulls_last(k) for k in keys]).select(*keys).limit(1).first()
    return tuple(row) if row else None
