"""Stream counters as rows (name, labels, value, ts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from paystrata.schemas import METRIC_SAMPLE


def observe_stream(df: DataFrame, name: str = "stream") -> DataFrame:
    """Counts taken inside the running query, without a second pass."""
    return df.observe(name, F.count(F.lit(1)).alias("processed"), F.sum("amount").alias("volume"))


class MetricsListener(StreamingQueryListener):
    """Collects the progress of every trigger; one small record per trigger."""

    def __init__(self) -> None:
        self.samples: list[tuple[str, dict[str, str], float, str]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        labels = {"query": p.name or str(p.id)}
        numbers = {"input_rows": p.numInputRows, "window_flush_time": (p.batchDuration or 0) / 1000.0}
        for state in p.stateOperators:
            dropped = state.customMetrics.get("numDroppedDuplicateRows", 0)
            numbers["duplicates"] = numbers.get("duplicates", 0) + dropped
            numbers["state_rows"] = numbers.get("state_rows", 0) + state.numRowsTotal
        for observed in p.observedMetrics.values():
            numbers.update({k: v for k, v in observed.asDict().items() if v is not None})
        self.samples += [(k, labels, float(v), p.timestamp) for k, v in numbers.items()]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = spark.createDataFrame(self.samples, "name string, labels map<string,string>, value double, ts string")
        return rows.withColumn("ts", F.to_timestamp("ts")).to(METRIC_SAMPLE)


def batch_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Counters that each cleaning batch wrote next to its outputs."""
    m = spark.read.parquet(f"{root}/metrics")
    return m.select(
        "batch", F.col("valid").alias("validated"), (F.col("read") - F.col("valid")).alias("rejected_or_metadata"),
        F.col("late").alias("late_events"),
        (F.col("valid") - F.col("late") - F.col("first_in_batch")).alias("duplicates"))
