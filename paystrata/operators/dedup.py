"""One row per key.

``row_number() = 1`` lets Spark keep one row per key on the map side
(``WindowGroupLimit``), so a key that holds a third of all rows sends one row per
map task to the shuffle, not all of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_group(df: DataFrame, keys: Iterable[str], order: Iterable[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, with their rank in ``rank``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def dedup_first(df: DataFrame, keys: Iterable[str], order: Iterable[Column]) -> DataFrame:
    """Keep the first row of each key in arrival order; ``order`` must be unique."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """Keep the last row of each key."""
    return dedup_first(df, keys, [F.col(c).desc() for c in order])
