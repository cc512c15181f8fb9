"""Entity graph: platforms, methods and accounts with the links between them.

Connections are a table, not a list in a node: a method that most accounts use
would otherwise collect all of them into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.parse import _col, first_truthy
from paystrata.operators.dedup import top_per_group

# Nodes shown per type.
NODE_CAPS = {"method": 8, "account": 10}


def account_key(user_id: Column | str, ref: Column | str) -> Column:
    user = _col(user_id)
    return F.when(F.length(user) > 5, user).otherwise(F.concat(F.lit("ACC_"), F.right(_col(ref), F.lit(4))))


def account_label(account: Column | str) -> Column:
    a = _col(account)
    return F.when(a.startswith("USR_"), F.concat(F.lit("UPI: "), F.substring(a, 5, 1 << 30), F.lit("@pay"))) \
        .otherwise(F.concat(F.lit("Bank: "), a))


def graph_facts(tx: DataFrame) -> DataFrame:
    """(platform, method, account, amount, is_anomalous) with fallbacks."""
    return tx.select(
        F.coalesce(F.nullif("platform_name", F.lit("")), F.lit("Unknown Platform")).alias("platform"),
        first_truthy("method", "type", F.lit("UPI")).alias("method"),
        account_key("user_id", "ref_number").alias("account"), "amount", "is_anomalous")


_LINKED = {"platform": "method", "method": "account", "account": "platform"}


def graph_nodes(tx: DataFrame) -> DataFrame:
    """One row per (type, id): volume, count, number of connected entities, anomaly."""
    facts = graph_facts(tx)
    # One row per combination first: the three rollups and their distinct counts
    # then read the combinations, and the facts are scanned and shuffled once.
    combos = facts.groupBy("platform", "method", "account").agg(
        F.sum("amount").alias("volume"), F.count(F.lit(1)).alias("count"),
        F.max("is_anomalous").alias("is_anomalous"))
    nodes = None
    for kind, other in _LINKED.items():
        pairs = combos.groupBy(kind, other).agg(
            F.sum("volume").alias("volume"), F.sum("count").alias("count"),
            F.max("is_anomalous").alias("is_anomalous"))
        part = pairs.groupBy(F.col(kind).alias("id")).agg(
            F.sum("volume").alias("volume"), F.sum("count").alias("count"),
            F.count(F.lit(1)).alias("connections"), F.max("is_anomalous").alias("is_anomalous"),
        ).select(
            F.lit(kind).alias("type"), "id",
            (account_label("id") if kind == "account" else F.col("id")).alias("label"),
            "volume", "count", "connections",
            (F.coalesce(F.col("is_anomalous"), F.lit(False)) if kind == "account" else F.lit(None).cast("boolean"))
            .alias("is_anomalous"))
        nodes = part if nodes is None else nodes.unionByName(part)
    return nodes


def node_connections(tx: DataFrame) -> DataFrame:
    """Distinct (type, id, connected): the members behind ``connections``."""
    facts = graph_facts(tx)
    pairs = F.array(*[
        F.struct(F.lit(kind).alias("type"), F.col(kind).alias("id"), F.col(other).alias("connected"))
        for kind, other in _LINKED.items()])
    return facts.select(F.explode(pairs).alias("p")).select("p.*").distinct()


def graph_edges(tx: DataFrame) -> DataFrame:
    """Distinct typed links platform→method and method→account."""
    links = F.array(*[
        F.struct(F.lit(a).alias("source_type"), F.col(a).alias("source"),
                 F.lit(b).alias("target_type"), F.col(b).alias("target"))
        for a, b in (("platform", "method"), ("method", "account"))])
    return graph_facts(tx).select(F.explode(links).alias("l")).select("l.*").distinct()


def neighbours(edges: DataFrame, node_type: str | None = None, node: str | None = None) -> DataFrame:
    """(type, id, neighbour_type, neighbour) in both directions, of one node or of all."""
    ends = F.array(
        F.struct(F.col("source_type").alias("type"), F.col("source").alias("id"),
                 F.col("target_type").alias("neighbour_type"), F.col("target").alias("neighbour")),
        F.struct(F.col("target_type").alias("type"), F.col("target").alias("id"),
                 F.col("source_type").alias("neighbour_type"), F.col("source").alias("neighbour")))
    if node is not None:
        edges = edges.filter((F.col("source") == node) | (F.col("target") == node))
    both = edges.select(F.explode(ends).alias("e")).select("e.*")
    if node is not None:
        both = both.filter(F.col("id") == node)
    if node_type is not None:
        both = both.filter(F.col("type") == node_type)
    return both.distinct()


def cap_nodes(nodes: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """At most ``caps[type]`` nodes per type, largest volume first; others whole."""
    limits = NODE_CAPS if caps is None else caps
    open_types = nodes.filter(~F.col("type").isin(list(limits)))
    for kind, cap in limits.items():
        capped = top_per_group(nodes.filter(F.col("type") == kind), ["type"],
                               [F.round("volume", 2).desc(), F.col("id")], cap).drop("rank")
        open_types = open_types.unionByName(capped)
    return open_types


def induced_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends in ``nodes``."""
    for end in ("source", "target"):
        keep = nodes.select(F.col("type").alias(f"{end}_type"), F.col("id").alias(end))
        edges = edges.join(keep, [f"{end}_type", end], "left_semi")
    return edges
