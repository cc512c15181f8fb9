"""Global running values, graph skew shape and alert rules against plain Python."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paystrata.operators import graph, prefix, quality


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_running_matches_a_loop(spark, ranges):
    rng = random.Random(ranges)
    # A third of the rows share one order value; the second key makes it unique.
    rows = [(7 if i % 3 == 0 else rng.randint(0, 50), i, float(rng.randint(-9, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, v double").repartition(5)
    out = {r["b"]: (r["total"], r["top"]) for r in prefix.running(
        df, ["a", "b"], {"total": ("sum", "v"), "top": ("max", "v")}, ranges).collect()}
    total, top = 0.0, float("-inf")
    for _, b, v in sorted(rows):
        total, top = total + v, max(top, v)
        assert out[b] == (total, top)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=30))
def test_running_skips_nulls(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    out = [r["s"] for r in prefix.running(df, ["i"], {"s": ("sum", "v")}, 3).orderBy("i").collect()]
    seen, expected = None, []
    for v in values:
        seen = v if seen is None else seen + (v or 0)
        expected.append(seen)
    assert out == expected


def test_late_rule_is_strict(spark):
    rows = [(1, "2024-01-01 22:00:00"), (2, "2024-01-01 21:59:50"), (3, "2024-01-01 21:59:40"), (4, "2024-01-01 21:59:49")]
    df = spark.createDataFrame(rows, "n int, event_ts string").withColumn("event_ts", F.to_timestamp("event_ts"))
    assert [r["late"] for r in prefix.late_flags(df, ["n"]).orderBy("n").collect()] == [False, False, True, True]


def test_late_rule_uses_carried_maximum(spark):
    df = spark.createDataFrame([(1, "2024-01-01 21:59:40")], "n int, event_ts string").withColumn(
        "event_ts", F.to_timestamp("event_ts"))
    carried = F.to_timestamp(F.lit("2024-01-01 22:00:00"))
    assert prefix.late_flags(df, ["n"], carried_max=carried).first()["late"]


def test_no_one_task_window(spark):
    """Only the per-range offsets (one row per range) may gather in one task."""
    df = spark.range(1000).withColumn("v", F.lit(1))
    plan = prefix.running(df, ["id"], {"s": ("sum", "v")}, 8)._jdf.queryExecution().executedPlan().toString()
    single = plan.split("Exchange SinglePartition")[1:]
    assert len(single) == 1 and "HashAggregate" in single[0]


def test_graph_fallbacks(spark):
    tx = spark.createDataFrame(
        [("", None, "DEPOSIT", "U1", "TXN_1234", 5.0, True), ("P", "UPI", "DEPOSIT", "USR_77", "TXN_9", 7.0, False),
         ("P", "UPI", "DEPOSIT", "USR_77", "TXN_10", 1.0, True)],
        "platform_name string, method string, type string, user_id string, ref_number string, amount double, is_anomalous boolean")
    nodes = {(r["type"], r["id"]): r for r in graph.graph_nodes(tx).collect()}
    assert nodes[("platform", "Unknown Platform")]["volume"] == 5.0
    assert nodes[("method", "DEPOSIT")]["connections"] == 1
    assert nodes[("account", "ACC_1234")]["label"] == "Bank: ACC_1234"
    assert nodes[("account", "USR_77")]["label"] == "UPI: 77@pay" and nodes[("account", "USR_77")]["is_anomalous"]
    assert nodes[("account", "USR_77")]["count"] == 2
    edges = graph.graph_edges(tx)
    assert edges.count() == 4
    assert [r["neighbour"] for r in graph.neighbours(edges, "method", "UPI").orderBy("neighbour").collect()] == ["P", "USR_77"]


def test_same_id_in_two_types_stays_apart(spark):
    tx = spark.createDataFrame([("X", "X", "DEPOSIT", "USR_77", "T", 1.0, False)],
                               "platform_name string, method string, type string, user_id string, ref_number string, "
                               "amount double, is_anomalous boolean")
    assert graph.graph_nodes(tx).filter("id = 'X'").count() == 2


def test_cap_nodes_keeps_largest(spark):
    rows = [("method", f"m{i:02d}", float(i)) for i in range(20)] + [("platform", f"p{i}", 1.0) for i in range(15)]
    nodes = spark.createDataFrame(rows, "type string, id string, volume double")
    kept = graph.cap_nodes(nodes).collect()
    assert sorted(r["id"] for r in kept if r["type"] == "method") == [f"m{i}" for i in range(12, 20)]
    assert sum(r["type"] == "platform" for r in kept) == 15


def series(spark, name, step, values, column):
    return spark.createDataFrame([(name, i * step, v) for i, v in enumerate(values)], f"series string, t bigint, {column} bigint")


@pytest.mark.parametrize("block", [3900, 7200, 86400])
def test_rates_do_not_depend_on_the_block(spark, block):
    rng = random.Random(4)
    total, values = 0, []
    for _ in range(200):
        total += rng.randint(0, 3)
        values.append(total)
    out = {r["t"]: r["rate_processed"] for r in quality.rates(
        series(spark, "s", 60, values, "processed"), ["processed"], 3600, block).collect()}
    assert len(out) == 200
    for i, v in enumerate(values):
        first = values[max(0, i - 60)]
        assert out[i * 60] == pytest.approx((v - first) / 3600)


def test_no_flow_fires_after_the_hold(spark):
    flat = list(range(10)) + [9] * 80
    fired = [r["t"] for r in quality.alert_no_flow(series(spark, "s", 60, flat, "processed")).filter("firing").collect()]
    # Flat since minute 9: the rate is zero from minute 69, and fires five minutes later.
    assert min(fired) == 74 * 60


def test_duplicate_share_hold(spark):
    rows = [("s", i * 60, 100, 50 if 3 <= i < 12 else 0) for i in range(20)]
    df = spark.createDataFrame(rows, "series string, t bigint, read bigint, duplicates bigint")
    fired = sorted(r["t"] // 60 for r in quality.alert_duplicates(df).filter("firing").collect())
    assert fired == [8, 9, 10, 11]


def test_ranges_follow_the_rows(spark, monkeypatch):
    """A third of the rows share one order value; the unique second key still cuts them."""
    monkeypatch.setattr(prefix, "ROWS_PER_RANGE", 100)
    df = spark.range(3000).select((F.col("id") * (F.col("id") % 3)).alias("a"), "id")
    assert prefix.ranges_of(df, 100) == 30
    kept = []

    def keep(rows, label):
        kept.append(prefix.materialize(rows, label))
        return kept[-1]

    out = prefix.running(df, ["a", "id"], {"n": ("sum", F.lit(1))}, 30, keep)
    assert out.agg(F.max("n"), F.count_distinct("n")).first() == (3000, 3000)
    assert kept[0].groupBy("__range").count().agg(F.max("count")).first()[0] <= 300
