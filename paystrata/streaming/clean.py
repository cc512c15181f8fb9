"""The event stream: raw topics → clean events, dead letters, metadata, windows.

Two queries, each with its own checkpoint:

1. ``start_cleaning`` parses, validates and routes late events. Spark's stateful
   operators drop late rows silently, so lateness is decided before them, against
   the largest event time so far; that maximum travels between batches in a
   one-row table versioned by batch id. A replayed batch reads the version of the
   batch before it and overwrites its own outputs, so it repeats its answer.
2. ``start_dedup`` keeps the first sight of each reference in the state store.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from paystrata.functions.parse import default_url, first_truthy, parse_ts, to_amount
from paystrata.operators.dedup import dedup_first
from paystrata.operators.dims import resolve_dim
from paystrata.operators.prefix import late_flags
from paystrata.operators.validate import (
    LATE, event_text, route, split_valid, validate_landing, validate_metadata, validate_transactions)
from paystrata.sources.bronze import PARTITIONS, parse_payload, publish, with_partitions
from paystrata.sources.layers import Layers
from paystrata.sources.tables import read_version, write_version
from paystrata.session import exists, materialize, scratch, settings

# Fixed values.
ORIGIN = "stream-cleaning-stage"
LATENESS_SECONDS = 10
WINDOW = "5 seconds"
DEDUP_SECONDS = 3600
STREAM_USER = "STREAM_USER"
# Arrival order over all topics and partitions; offsets order one partition alone.
ARRIVAL = ["appended", "topic", "partition", "offset"]


def to_clean(df: DataFrame) -> DataFrame:
    """Valid raw columns to clean ones, with the stream's defaults."""
    return df.withColumns({
        "amount": to_amount("amount"), "event_ts": parse_ts(event_text()),
        "method": F.coalesce(first_truthy("method", "method_name"), F.lit("UPI")),
        "type": F.coalesce("type", F.lit("DEPOSIT")), "status": F.coalesce("status", F.lit("SUCCESS"))})


CLEAN_COLUMNS = ["ref_number", "amount", "platform_name", "method", "type", "status", "event_ts"]


def split_late(valid: DataFrame, order: list[str], lateness_seconds: int = LATENESS_SECONDS,
               carried_max: Column | None = None, keep=materialize) -> DataFrame:
    """Adds ``late`` and, for late rows, ``error``. Late rows never reach dedup state."""
    flagged = late_flags(valid, order, "event_ts", lateness_seconds, carried_max, keep)
    return flagged.withColumn("error", F.when(F.col("late"), F.concat(F.lit(LATE), event_text())))


def _save(df: DataFrame, root: str, name: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")


def _publish(df: DataFrame, root: str, name: str, batch_id: int) -> None:
    """As ``_save``, for a folder that another query reads: a batch that was written whole
    stays as it is, so a replay never takes a listed file away from its reader."""
    if not exists(df.sparkSession, f"{root}/{name}/batch={batch_id}/_SUCCESS"):
        _save(df, root, name, batch_id)


def clean_batch(batch: DataFrame, batch_id: int, root: str, lateness_seconds: int = LATENESS_SECONDS) -> None:
    """One micro-batch of (topic, value, …) rows to the folders under ``root``."""
    spark = batch.sparkSession
    # One write, then every branch reads it: the source is read once, and a lost
    # executor finds the rows in the shared folder. They go when the batch is done.
    with scratch(spark) as keep:
        if "appended" not in batch.columns:  # a source of one partition needs no append time
            batch = batch.withColumn("appended", F.lit(None).cast("timestamp"))
        parsed = keep(parse_payload(batch), "batch")
        transactions, metadata = route(parsed)

        kept, refused = split_valid(validate_metadata(metadata), ORIGIN)
        _save(kept.select("topic", F.col("payload").alias("value")), root, "metadata", batch_id)

        valid, invalid = split_valid(validate_transactions(transactions), ORIGIN)
        # As a number: a Python datetime would pass through the driver's time zone.
        before = (read_version(spark, f"{root}/max_event_ts", batch_id - 1)
                  .select(F.unix_micros("max_event_ts")).first()[0] if batch_id > 0 else None)
        carried = F.timestamp_micros(F.lit(before).cast("bigint"))
        flagged = keep(split_late(to_clean(valid), ARRIVAL, lateness_seconds, carried, keep), "flagged")
        newest = flagged.agg(F.greatest(F.max("max_event_ts"), carried).alias("max_event_ts"))

        on_time = flagged.filter(~F.col("late")).drop("error", "late", "max_event_ts")
        # A reference repeated within the batch is folded here, so one hot reference
        # reaches the state store as a single row.
        first = dedup_first(on_time, ["ref_number"], [F.col(c) for c in ARRIVAL])
        _publish(first.select(*CLEAN_COLUMNS, *ARRIVAL), root, "on_time", batch_id)

        _, late = split_valid(flagged.drop("late", "max_event_ts"), ORIGIN)
        _save(refused.unionByName(invalid).unionByName(late), root, "dlq", batch_id)
        kept_rows = spark.read.parquet(f"{root}/on_time/batch={batch_id}").count()
        counts = flagged.agg(F.count(F.lit(1)).alias("valid"), F.count_if("late").alias("late")).withColumns(
            {"read": F.lit(parsed.count()), "first_in_batch": F.lit(kept_rows)})
        _save(counts, root, "metrics", batch_id)
        write_version(newest, f"{root}/max_event_ts", batch_id)


def start_cleaning(events: DataFrame, root: str, lateness_seconds: int = LATENESS_SECONDS,
                   trigger: dict | None = None) -> StreamingQuery:
    return (events.writeStream.queryName("cleaning")
            .foreachBatch(lambda df, i: clean_batch(df, i, root, lateness_seconds))
            .option("checkpointLocation", f"{root}/_checkpoints/cleaning")
            .trigger(**(trigger or {"availableNow": True})).start())


CLEAN_SCHEMA = ("ref_number string, amount double, platform_name string, method string, type string, "
                "status string, event_ts timestamp, appended timestamp, topic string, partition int, offset bigint, "
                "batch bigint")


def read_on_time(spark: SparkSession, root: str) -> DataFrame:
    return spark.readStream.schema(CLEAN_SCHEMA).parquet(f"{root}/on_time")


class FirstSight(StatefulProcessor):
    """The first row of a key in arrival order; its sight is remembered for ``ttl_ms`` of
    processing time, and later sights do not prolong it."""

    def __init__(self, order: list[str], ttl_ms: int):
        self.order, self.ttl_ms = order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "here boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        self.seen.update((True,))
        # Nulls first, as Spark orders them.
        yield min(rows, key=lambda r: [(r[c] is not None, r[c]) for c in self.order])

    def close(self) -> None:
        pass


#: State in RocksDB: it may outgrow the executors' memory, and expired keys go by compaction.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_dedup(clean: DataFrame, keys: list[str], order: list[str], ttl_seconds: int = DEDUP_SECONDS) -> DataFrame:
    """First row of each key in arrival order, forgotten ``ttl_seconds`` of
    processing time after its first sight; later sights do not prolong it.

    A trigger may bundle several upstream batches, so the earliest row is chosen
    here too. Upstream folds each batch to one row per key, so a group is as small
    as the number of bundled batches. Needs ``STATE_STORE`` as the state store.
    """
    return clean.groupBy(*keys).transformWithState(
        FirstSight(order, max(1, int(ttl_seconds * 1000))), clean.schema, "Append", "ProcessingTime")


def stream_dedup_any(clean: DataFrame, keys: list[str], ttl_seconds: int = DEDUP_SECONDS) -> DataFrame:
    """The same without Python, for sources whose triggers hold a key once: within
    one trigger any of several rows of a key may be the one kept.

    The watermark runs on the processing time, at half the period: an entry ends a
    delay after its first sight and is evicted a delay after that.
    """
    return (clean.withColumn("seen_at", F.current_timestamp())
            .withWatermark("seen_at", f"{ttl_seconds / 2} seconds")
            .dropDuplicatesWithinWatermark(keys))


def start_dedup(clean: DataFrame, root: str, ttl_seconds: int = DEDUP_SECONDS,
                trigger: dict | None = None) -> StreamingQuery:
    first = stream_dedup(clean, ["ref_number"], ["batch", *ARRIVAL], ttl_seconds)
    # Processing-time state asks for empty batches without end, which keeps an
    # availableNow run from finishing; expired keys are evicted with the next data.
    with settings(clean.sparkSession, {"spark.sql.streaming.noDataMicroBatches.enabled": "false",
                                       "spark.sql.streaming.stateStore.providerClass": STATE_STORE}):
        return _start_dedup(first, root, trigger)


def _start_dedup(first: DataFrame, root: str, trigger: dict | None) -> StreamingQuery:
    return (first.writeStream.queryName("dedup").outputMode("append")
            .format("parquet").option("path", f"{root}/clean")
            .option("checkpointLocation", f"{root}/_checkpoints/dedup")
            .trigger(**(trigger or {"availableNow": True})).start())


def with_lateness(df: DataFrame, lateness: str = f"{LATENESS_SECONDS} seconds") -> DataFrame:
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark("event_ts", lateness)


def tumbling_volume(df: DataFrame, width: str = WINDOW) -> DataFrame:
    """Count and amount per event-time window; works on a stream and on a table."""
    return df.groupBy(F.window("event_ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("amount").alias("volume"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count", "volume")


def passthrough(events: DataFrame) -> DataFrame:
    """Metadata events with a platform, on their clean topic; stateless."""
    _, metadata = route(parse_payload(events))
    return validate_metadata(metadata).filter(F.col("error").isNull()).select(
        "topic", F.col("payload").alias("value"))


FLUSHED = {
    "platforms": "id bigint, name string, url string", "payment_methods": "id bigint, name string, type string",
    "transactions": "ref_number string, user_id string, platform_id bigint, method_id bigint, amount double, "
                    "type string, status string, event_ts timestamp"}


def flushed(spark: SparkSession, root: str) -> Layers:
    """The star tables of the flush; transactions are looked up by their reference."""
    return Layers(spark, root, FLUSHED, {"transactions": "ref_number"})


def read_flushed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A star table of the flush, all batches."""
    return flushed(spark, root).read(name)


def flush_batch(batch: DataFrame, batch_id: int, root: str, clean_topic: str = "payments.clean.transactions",
                kafka: dict[str, str] | None = None) -> None:
    """Window flush: publish, resolve both dimensions, insert absent transactions.

    Set-wise: a constant number of jobs per batch, whatever its size. A batch adds its new
    rows as a run of each table and commits them with one manifest; a replay starts from the
    manifest before and overwrites its own runs. References are looked up by filters and
    slices, so a batch does not read the history of transactions.
    """
    spark = batch.sparkSession
    store = flushed(spark, root)
    with scratch(spark) as keep:
        rows = keep(batch, "flush")
        if kafka:
            publish(rows, F.lit(clean_topic), kafka=kafka)
        else:
            rows.withColumn("topic", F.lit(clean_topic)).write.mode("overwrite").json(f"{root}/published/batch={batch_id}")
        runs = store.runs(batch_id)
        before = {name: store.read(name, runs) for name in ("platforms", "payment_methods")}
        with_platform, platforms = resolve_dim(rows, before["platforms"], "platform_name", "platform_id",
                                               extra={"url": default_url("name")}, keep=keep)
        resolved, methods = resolve_dim(with_platform, before["payment_methods"], "method", "method_id",
                                        extra={"type": F.lit("UPI")}, keep=keep)
        columns = store.read("transactions", []).columns
        new = dedup_first(resolved.withColumn("user_id", F.lit(STREAM_USER)).select(*columns), ["ref_number"],
                          [F.col("event_ts"), F.col("amount")])
        added = {"transactions": store.absent("transactions", new, runs, keep)}
        for name, table in (("platforms", platforms), ("payment_methods", methods)):
            added[name] = table.join(before[name].select("id"), "id", "left_anti").select(*before[name].columns)
        store.commit(batch_id, added)


def start_flush(clean: DataFrame, root: str, trigger: dict | None = None, **options) -> StreamingQuery:
    return (clean.writeStream.queryName("flush")
            .foreachBatch(lambda df, i: flush_batch(df, i, root, **options))
            .option("checkpointLocation", f"{root}/_checkpoints/flush")
            .trigger(**(trigger or {"processingTime": WINDOW})).start())


def landing_rows(events: DataFrame) -> DataFrame:
    """Validated clean-topic events with their Bronze partition columns."""
    ok = validate_landing(parse_payload(events)).filter(F.col("error").isNull()).drop("error", "reason", "payload")
    return with_partitions(ok)


def land_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """One micro-batch of clean-topic events: accepted rows to partitioned JSON, the others
    to the dead letters; read and parsed once. A replay overwrites its own folders."""
    with scratch(batch.sparkSession) as keep:
        checked = keep(validate_landing(parse_payload(batch)), "landing")
        ok, dead = split_valid(checked)
        drop = [c for c in ("topic", "partition", "offset", "appended", "reason", "payload") if c in ok.columns]
        (with_partitions(ok.drop(*drop)).hint("rebalance", *PARTITIONS).write.mode("overwrite")
         .partitionBy(*PARTITIONS).json(f"{root}/bronze/batch={batch_id}"))
        dead.write.mode("overwrite").json(f"{root}/bronze_dlq/batch={batch_id}")


def start_bronze(events: DataFrame, root: str, trigger: dict | None = None) -> tuple[StreamingQuery, ...]:
    """The landing query: accepted rows to partitioned JSON, rejected rows to the dead letters."""
    return ((events.writeStream.queryName("bronze").foreachBatch(lambda df, i: land_batch(df, i, root))
             .option("checkpointLocation", f"{root}/_checkpoints/bronze")
             .trigger(**(trigger or {"availableNow": True})).start()),)
