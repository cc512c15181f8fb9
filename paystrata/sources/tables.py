"""Keyed table writes as joins: upserts, first-write-wins, cascading deletes.

Each function returns the new content of the table; ``write_version`` stores it
beside the version it was built from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.operators.dedup import dedup_first, latest_per_key
from paystrata.sources.buckets import Buckets


def _latest(updates: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    return latest_per_key(updates, keys, order) if order else updates


def upsert(
    target: DataFrame, updates: DataFrame, keys: list[str], mode: str = "replace", order: list[str] | None = None,
) -> DataFrame:
    """Keyed upsert. ``order`` names the arrival columns when ``updates`` repeats keys.

    ``replace`` swaps the whole row (columns not supplied become null);
    ``update`` sets the supplied columns and keeps the others.
    """
    incoming = _latest(updates, keys, order)
    if mode == "replace":
        kept = target.join(incoming.select(*keys), keys, "left_anti")
        extra = [c for c in incoming.columns if c not in target.columns]
        return kept.unionByName(incoming.drop(*extra), allowMissingColumns=True)
    if mode != "update":
        raise ValueError(f"unknown mode {mode!r}")
    supplied = [c for c in incoming.columns if c in target.columns and c not in keys]
    u = incoming.select(*keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__u_{c}") for c in supplied])
    joined = target.join(u, keys, "full_outer")
    return joined.select(*[
        F.when(F.col("__hit"), F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c) if c in supplied else F.col(c)
        for c in target.columns])


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First write wins: rows whose key exists, or came earlier in ``new``, are skipped."""
    first = dedup_first(new, keys, order)
    added = first.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(added.select(*[c for c in added.columns if c in target.columns]),
                              allowMissingColumns=True)


def merge_into(updates: DataFrame, table: str, keys: list[str], mode: str = "replace",
               order: list[str] | None = None) -> None:
    """The same upserts in place, for catalogs with row-level operations (such as
    Iceberg or Delta): only the files that hold a matched key are rewritten."""
    incoming = _latest(updates, keys, order).alias("u")
    on = reduce(lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"u.{k}") for k in keys])
    merge = incoming.mergeInto(table, on)
    if mode == "insert":
        merge.whenNotMatched().insertAll().merge()
    elif mode == "update":
        supplied = {c: F.col(f"u.{c}") for c in updates.columns}
        merge.whenMatched().update({c: v for c, v in supplied.items() if c not in keys}) \
            .whenNotMatched().insert(supplied).merge()
    else:
        merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def table_count(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).agg(F.count(F.lit(1)).alias("rows"))


def append_facts(facts: DataFrame, rows: DataFrame, kind: str) -> DataFrame:
    """Append review, complaint or news rows (platform id resolved) with defaults."""
    return facts.unionByName(with_fact_defaults(rows, kind), allowMissingColumns=True)


# Defaults of the fact columns by kind.
FACT_DEFAULTS: dict[str, dict[str, str]] = {
    "review": {"author": "Anonymous", "content": ""},
    "complaint": {"title": "No Subject", "description": "", "status": "UNRESOLVED"},
    "news": {"title": "", "content": "", "url": "", "source": "Web Scraper"},
}


def with_fact_defaults(rows: DataFrame, kind: str) -> DataFrame:
    filled = {c: F.coalesce(F.col(c), F.lit(v)) if c in rows.columns else F.lit(v)
              for c, v in FACT_DEFAULTS[kind].items()}
    if kind == "review":
        rating = F.col("rating").try_cast("double") if "rating" in rows.columns else F.lit(None).cast("double")
        filled["rating"] = F.coalesce(rating, F.lit(0.0))
    out = rows.withColumns(filled)
    return out.select("platform_id", *filled)


def delete_cascade(
    tables: dict[str, DataFrame], parent: str, key: str, ids: DataFrame, foreign_keys: dict[str, str],
) -> dict[str, DataFrame]:
    """Remove the parent rows in ``ids`` and every child row that points to them."""
    gone = ids.select(F.col(key).alias("__gone")).distinct()
    columns = {parent: key, **foreign_keys}
    return {
        name: df.join(gone, F.col(columns[name]) == F.col("__gone"), "left_anti") if name in columns else df
        for name, df in tables.items()}


def write_version(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write one version of a table to its own folder and read it back.

    A run writes ``version`` from ``version - 1``: a plan never reads the folder
    it writes, and a retried run writes the same content to the same place.
    """
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
    return read_version(df.sparkSession, root, version)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """A version of a table, whether written whole or in buckets."""
    stored = Buckets(spark, root, [])
    return stored.read(version) if stored.exists(version) else spark.read.parquet(f"{root}/v={version}")
