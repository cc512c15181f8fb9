"""Connected components of an edge table, by hooking to the least neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch


EDGES_PER_PART = 500_000


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b): comp is the least node it reaches.

    Each round hooks every component to its least neighbour, follows the pointers twice and
    contracts the edges, so components shrink by more than half a round. Nothing is collected.
    """
    both = lambda e: e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.keep(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    # As many parts as the edges fill: many rounds over few rows cost more in tasks than in work.
    parts = max(1, -(-edges.count() // EDGES_PER_PART))
    keep = lambda df, label: scratch.keep(df.coalesce(parts), label)
    labels = keep(both(edges).select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct(), "labels")
    while not edges.isEmpty():
        hook = both(edges).groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("p"))
        first = keep(hook, "hook")
        up = first.select(F.col("c").alias("p"), F.col("p").alias("q"))
        hook = first
        for _ in range(2):
            hook = hook.join(up, "p", "left").select("c", F.coalesce("q", "p").alias("p"))
        hook = keep(hook, "hook")
        scratch.drop(first)
        moved = keep(labels.join(hook.withColumnRenamed("c", "comp"), "comp", "left").select("node", F.coalesce("p", "comp").alias("comp")), "labels")
        to = lambda side: hook.select(F.col("c").alias(side), F.col("p").alias(f"n{side}"))
        fewer = keep(edges.join(to("a"), "a").join(to("b"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
                             .filter("a <> b").distinct(), "edges")
        for old in (labels, edges, hook):
            scratch.drop(old)
        labels, edges = moved, fewer
    scratch.drop(edges)
    return labels
