"""Counters, audits, consumer lag and alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from paystrata.operators.gold import REQUIRED


def null_audit(silver: DataFrame) -> DataFrame:
    """Rows audited and rows that lack a reference, user or amount, in one pass."""
    lacks = F.col("ref_number").isNull() | F.col("user_id").isNull() | F.col("amount").isNull()
    return silver.agg(F.count(F.lit(1)).alias("valid_records"), F.count_if(lacks).alias("null_fields_detected"))


def quality_metrics(raw: DataFrame) -> DataFrame:
    """read, rejected, duplicate and written rows of a Bronze batch.

    References are folded first, so the distinct count is a plain count and a
    reference with a third of the rows is combined on the map side.
    """
    valid = F.lit(True)
    for name in REQUIRED:
        valid = valid & F.col(name).isNotNull()
    per_ref = raw.groupBy(F.when(valid, F.col("ref_number")).alias("ref")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("ref").isNotNull()
    return per_ref.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("rejected_rows"),
        F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(known).alias("rows_written"))


def observed(df: DataFrame, name: str, **tests: Column) -> tuple[DataFrame, Observation]:
    """Counts taken while another action runs: total rows and rows per test."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(test).alias(label) for label, test in tests.items()]), seen


def rejections_by_reason(dead: DataFrame, topic: str = "topic", reason: str = "error") -> DataFrame:
    return dead.groupBy(F.col(topic).alias("topic"), F.col(reason).alias("reason")).agg(
        F.count(F.lit(1)).alias("rejected"))


def consumer_lag(read: DataFrame, end_offsets: DataFrame) -> DataFrame:
    """End offset minus last offset read per partition; a caught-up partition shows 1.
    A partition that nobody has read has no last offset and lags by its whole length."""
    last = read.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))
    return end_offsets.join(last, ["topic", "partition"], "left").withColumn(
        "lag", F.col("end_offset") - F.coalesce("last_offset", F.lit(0)))


def run_summary(runs: DataFrame) -> DataFrame:
    """Status, duration, error and array sizes of collection runs."""
    def size(c: str) -> Column:
        return F.size(F.coalesce(F.col(c), F.array()))
    seconds = F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))
    return runs.select(
        "scraper", "url", "status", (seconds / 1e6).alias("duration_seconds"), "error",
        size("headings").alias("headings_count"), size("categories").alias("categories_count"),
        size("public_content").alias("public_content_count"), F.col("start_ts").alias("timestamp"))


def processed_vs_valid(pages: DataFrame, keep: Column) -> DataFrame:
    return pages.agg(F.count(F.lit(1)).alias("processed"), F.count_if(keep).alias("valid"))


# ---------------------------------------------------------------- alert rules
#
# Samples are (series, t, value…) with t in epoch seconds on the evaluation grid.
# A rule looks back a fixed time. Each series is cut into time blocks, the samples
# within the look-back of a block are repeated in the next one, and windows run
# per (series, block): a series with a third of all samples is many tasks.


def _blocked(samples: DataFrame, lookback: int, block: int) -> DataFrame:
    if block < lookback:
        raise ValueError("a block must be at least as long as the look-back")
    own = F.floor(F.col("t") / block)
    return samples.withColumn("__block", F.explode(F.array_distinct(
        F.array(own, F.floor((F.col("t") + lookback) / block)))))


def _own(df: DataFrame, block: int) -> DataFrame:
    return df.filter(F.floor(F.col("t") / block) == F.col("__block")).drop("__block")


def _look_back(seconds: int) -> Window:
    return Window.partitionBy("series", "__block").orderBy("t").rangeBetween(-seconds, 0)


def rates(samples: DataFrame, counters: list[str], seconds: int, block: int = 86400) -> DataFrame:
    """Per-second increase of each counter over the last ``seconds``.

    Counters start again from zero with their process, so the positive steps between
    samples are added up; after a reset the step is the new value itself.
    """
    w, before = _look_back(seconds), Window.partitionBy("series", "__block").orderBy("t")
    blocked = _blocked(samples, seconds, block)
    for c in counters:
        last = F.lag(c).over(before)
        step = F.when(F.col(c) >= last, F.col(c) - last).otherwise(F.col(c))
        blocked = blocked.withColumn(f"__s_{c}", F.when(last.isNotNull(), step))
    # A step belongs to the sample that ends it; the first sample inside the look-back
    # closes a step that began before it.
    first = {c: F.first(F.coalesce(f"__s_{c}", F.lit(0))).over(w) for c in counters}
    out = {f"rate_{c}": (F.sum(F.coalesce(f"__s_{c}", F.lit(0))).over(w) - first[c]) / F.lit(float(seconds)) for c in counters}
    return _own(blocked.withColumns(out).drop(*[f"__s_{c}" for c in counters]), block)


def held(samples: DataFrame, condition: Column, seconds: int, block: int = 86400) -> DataFrame:
    """``firing``: the condition holds at every sample of the last ``seconds``, and
    has been observed for that long."""
    w = _look_back(seconds)
    marked = samples.withColumn("__true", F.coalesce(condition, F.lit(False)).cast("int"))
    firing = (F.min("__true").over(w) == 1) & (F.min("t").over(w) <= F.col("t") - seconds)
    return _own(_blocked(marked, seconds, block).withColumn("firing", firing), block).drop("__true")


def alert_no_flow(samples: DataFrame) -> DataFrame:
    """No processed event for an hour, for five minutes."""
    return held(rates(samples, ["processed"], 3600), F.col("rate_processed") == 0, 300)


def alert_rejections(samples: DataFrame) -> DataFrame:
    """More than ten percent of the five-minute flow rejected, for two minutes."""
    r = rates(samples, ["processed", "rejected"], 300)
    return held(r, F.col("rate_rejected") / (F.col("rate_processed") + 1) * 100 > 10, 120)


def alert_etl_rejects(samples: DataFrame) -> DataFrame:
    """Any row rejected by the batch load within fifteen minutes, for one minute."""
    return held(rates(samples, ["rejected"], 900), F.col("rate_rejected") > 0, 60)


def alert_duplicates(samples: DataFrame) -> DataFrame:
    """Duplicates above fifteen percent of the rows read, for five minutes."""
    return held(samples, F.col("duplicates") / (F.col("read") + 1) * 100 > 15, 300)
