"""Dimension lookup: names to ids, get-or-create, names back for reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.operators.prefix import row_numbers
from paystrata.session import materialize

# Fallback names.
UNKNOWN_PLATFORM = "Unknown Platform"
UNKNOWN_METHOD = "Unknown Method"


def _key(name: Column, ci: bool) -> Column:
    return F.lower(F.trim(name)) if ci else name


def assign_ids(names: DataFrame, name_col: str, start: int, keep: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Surrogate ids after ``start`` in name order."""
    return row_numbers(names, [name_col], "id", start, keep)


def resolve_dim(
    df: DataFrame, dim: DataFrame, name_col: str, id_col: str, ci: bool = False,
    extra: dict[str, Column] | None = None, keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``id_col``, dimension including the new names).

    New names are distinct before they meet the dimension, so a name that holds
    most rows costs one row per map task. ``extra`` fills the other columns of a
    new dimension row from its ``name``.
    """
    keyed_dim = dim.select("id", _key(F.col("name"), ci).alias("__key"))
    found = (df.filter(F.col(name_col).isNotNull())
             .groupBy(_key(F.col(name_col), ci).alias("__key"))
             .agg(F.min(F.trim(name_col) if ci else F.col(name_col)).alias("name")))
    new = found.join(keyed_dim, "__key", "left_anti").select("name")
    start = dim.agg(F.max("id")).first()[0] or 0
    created = assign_ids(keep(new, "names"), "name", start, keep).withColumn("id", F.col("id").cast(dim.schema["id"].dataType))
    if extra:
        created = created.withColumns(extra)
    # Written once: the stored size tells Spark whether the lookup may be broadcast.
    full = keep(dim.unionByName(created, allowMissingColumns=True), "dimension")
    lookup = full.select(F.col("id").alias(id_col), _key(F.col("name"), ci).alias("__key"))
    return (df.withColumn("__key", _key(F.col(name_col), ci)).join(lookup, "__key", "left").drop("__key")), full


def with_names(tx: DataFrame, platforms: DataFrame, methods: DataFrame) -> DataFrame:
    """Fact rows with ``platform_name`` and ``method_name``; unknown ids keep a text."""
    p = platforms.select(F.col("id").alias("platform_id"), F.col("name").alias("__p"))
    m = methods.select(F.col("id").alias("method_id"), F.col("name").alias("__m"))
    return (tx.join(p, "platform_id", "left").join(m, "method_id", "left")
            .withColumn("platform_name", F.coalesce("__p", F.lit(UNKNOWN_PLATFORM)))
            .withColumn("method_name", F.coalesce("__m", F.lit(UNKNOWN_METHOD))).drop("__p", "__m"))
