"""Batch load end to end: Bronze → Silver and dead letters → Gold, written once each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.operators.gold import REQUIRED, add_parts, channels_from, enrich, gold_parts, platforms_from
from paystrata.operators.dedup import dedup_first
from paystrata.operators.quality import quality_metrics
from paystrata.operators.validate import split_valid
from paystrata.schemas import SILVER_REPORT_COLUMNS
from paystrata.session import scratch, together
from paystrata.sources.buckets import BUCKETS, Buckets
from paystrata.sources.tables import read_version, write_version


def missing_required() -> Column:
    missing = F.array_join(F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]), lambda x: x.isNotNull()), ", ")
    return F.when(missing != "", F.concat(F.lit("Missing required fields: "), missing))


def silver_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Buckets:
    return Buckets(spark, f"{root}/silver", ["ref_number"], buckets)


def _write_gold(parts: DataFrame, root: str, version: int) -> None:
    parts = write_version(parts, f"{root}/gold_parts", version)
    together(lambda: write_version(channels_from(parts), f"{root}/gold_payment_channels", version),
             lambda: write_version(platforms_from(parts), f"{root}/gold_platform_metrics", version))


def run(bronze: DataFrame, root: str, version: int, order: list[Column], extended_flags: bool = False) -> DataFrame:
    """Load one Bronze batch as ``version`` of every table; returns the counters.

    Silver is an upsert on the reference, so loading the same batch again changes
    nothing. A load rewrites only the buckets of Silver that hold one of its references,
    and Gold by what came and what went in them: neither follows the size of Silver.
    """
    spark: SparkSession = bronze.sparkSession
    columns = [F.col(c) for c in SILVER_REPORT_COLUMNS]
    payload = F.when(F.col("error").isNotNull(), F.to_json(F.struct(*bronze.columns)))
    with scratch(spark) as keep:
        # The raw text is parsed once and becomes numbers and, for a rejected row, its dead letter;
        # every later branch reads these.
        marked = bronze.withColumn("error", missing_required()).withColumns({"payload": payload, "__order": F.struct(*order)})
        checked = keep(enrich(marked, extended_flags).select(*columns, "error", "payload", "__order"), "checked")
        valid, dead = split_valid(checked, "batch-load")
        incoming = dedup_first(valid.withColumn("scraped_at", F.current_timestamp()), ["ref_number"], [F.col("__order")])
        incoming = incoming.select(*columns, "scraped_at")
        counts = quality_metrics(checked.select("ref_number", "platform_name", F.col("error").isNull().alias("fine")).select(
            "ref_number", "platform_name", F.when(F.col("fine"), 1).alias("amount")))
        store = silver_table(spark, root)

        def layers() -> None:
            if version == 0:
                _write_gold(gold_parts(store.overwrite(incoming, 0)), root, 0)
                return
            change = store.upsert(incoming, version)
            before = read_version(spark, f"{root}/gold_parts", version - 1)
            _write_gold(add_parts(before, gold_parts(change.came), gold_parts(change.went)), root, version)

        # Three writes that do not wait for one another.
        done = together(layers, lambda: dead.write.mode("overwrite").json(f"{root}/dlq/v={version}"),
                        lambda: write_version(counts, f"{root}/metrics", version))
    return done[-1]


def rebuild(spark: SparkSession, silver: DataFrame, root: str, version: int) -> None:
    """Replace Silver and recompute both Gold tables from it."""
    _write_gold(gold_parts(silver_table(spark, root).overwrite(silver, version)), root, version)
