"""Shape of the plans: what is read, what is shuffled, what gathers in one task."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
# Queries that run whole jobs (streams, loads, model fits) before they return a frame.
EAGER = {"clean_stream", "stream_dead_letters", "stream_flush", "bronze_stream", "stream_passthrough", "batch_load",
         "bronze_roundtrip", "kmeans", "train_classifier", "anomaly_rate"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pairing_of_whole_tables(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name, absent", [
    ("gold_platform_metrics", ["o_comment", "c_name", "c_acctbal", "o_orderpriority"]),
    ("gold_payment_channels", ["c_mktsegment", "n_regionkey", "o_orderstatus"]),
    ("platform_summary", ["c_name", "o_orderpriority"]),
    ("similarity_search", ["label"]),
    ("silver_transactions", ["lang", "source", "n_chars"]),
])
def test_scans_are_pruned(spark, small, name, absent):
    df = QUERIES[name](spark, small)
    df._jdf.queryExecution().executedPlan()
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_of(df))
    assert schemas
    for column in absent:
        assert not any(f"{column}:" in s for s in schemas)


def test_filters_reach_the_scan(spark, small):
    plan = plan_of(QUERIES["transactions_by_platform"](spark, small))
    assert "PushedFilters: [IsNotNull(o_custkey)" in plan


def test_top_k_is_not_a_global_sort(spark, small):
    for name in ("recent_activity", "top_methods", "lookup_anomalies", "lookup_next_page"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, small))


def test_text_is_not_shuffled_for_silver(spark, small):
    """The deduplication's exchange carries the derived numbers, not the text."""
    df = QUERIES["silver_transactions"](spark, small)
    plan = plan_of(df)
    window = plan[plan.index("WindowGroupLimit"):]
    exchange = window[:window.index("Partial")]
    assert "raw_text" not in exchange


def test_per_group_limits_start_on_the_map_side(spark, small):
    for name in ("dedup_first", "latest_per_key", "upsert_repeated_keys", "insert_if_absent", "similarity_search",
                 "new_records", "platform_card_top", "induced_edges"):
        assert re.search(r"WindowGroupLimit[^\n]*Partial", plan_of(QUERIES[name](spark, small))), name


@pytest.mark.parametrize("name", ["graph_nodes", "quality_metrics", "platform_breakdown", "gold_payment_channels"])
def test_aggregates_fold_before_the_shuffle(spark, small, name):
    assert "partial_" in plan_of(QUERIES[name](spark, small))
