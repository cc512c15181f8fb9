"""Queries: serving reports, graph, counters, alerts and the audit document."""

from __future__ import annotations

from pyspark.sql import functions as F

from paystrata.operators import gold, graph, quality, report, serving, vector
from paystrata.plans import views
from paystrata.plans.oracle import EV, GRAPH, SAMPLES, STAR, TX, with_ctes
from paystrata.plans.registry import query


def _star(spark, sf):
    return views.facts(spark, sf), views.platforms(spark, sf), views.methods(spark, sf)


def _ts(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


# ---------------------------------------------------------------- star reports

@query("platform_breakdown", with_ctes(STAR, """
SELECT p.id, p.name, p.url, count(t.id) AS transaction_count,
  round(coalesce(sum(CASE WHEN t.type = 'DEPOSIT' THEN t.amount ELSE 0 END), 0), 2)::DOUBLE AS deposit_volume,
  round(coalesce(sum(CASE WHEN t.type = 'WITHDRAWAL' THEN t.amount ELSE 0 END), 0), 2)::DOUBLE AS withdrawal_volume,
  count(*) FILTER (t.is_anomalous) AS anomaly_count, count(*) FILTER (t.status = 'SUCCESS') AS success_count,
  count(*) FILTER (t.status = 'FAILED') AS failed_count,
  strftime(min(t.datetime), '%Y-%m-%d %H:%M:%S') AS first_transaction,
  strftime(max(t.datetime), '%Y-%m-%d %H:%M:%S') AS last_transaction,
  CASE WHEN count(t.id) > 0 THEN 'DATA_AVAILABLE' ELSE 'NO_DATA' END AS scan_status
FROM platforms p LEFT JOIN facts t ON t.platform_id = p.id GROUP BY p.id, p.name, p.url"""))
def platform_breakdown(spark, sf):
    tx, platforms, _ = _star(spark, sf)
    out = serving.platform_breakdown(platforms, tx)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_transaction", "last_transaction")})


@query("transactions_by_platform", with_ctes(STAR, """
SELECT t.id, t.ref_number, t.user_id, t.amount, t.type, t.status, t.is_anomalous,
  strftime(t.datetime, '%Y-%m-%d %H:%M:%S') AS datetime, p.name AS platform_name, p.url AS platform_url,
  m.name AS method_name, m.type AS method_type
FROM facts t JOIN platforms p ON t.platform_id = p.id JOIN methods m ON t.method_id = m.id"""))
def transactions_by_platform(spark, sf):
    return serving.transactions_by_platform(*_star(spark, sf)).withColumn(
        "datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))


@query("with_names", with_ctes(STAR, """
SELECT t.id, coalesce(p.name, 'Unknown Platform') AS platform_name, coalesce(m.name, 'Unknown Method') AS method_name
FROM facts t LEFT JOIN platforms p ON p.id = t.platform_id AND p.id <> 3 LEFT JOIN methods m ON m.id = t.method_id AND m.id <> 2"""))
def with_names(spark, sf):
    from paystrata.operators.dims import with_names as named
    tx, platforms, methods = _star(spark, sf)
    return named(tx, platforms.filter("id <> 3"), methods.filter("id <> 2")).select("id", "platform_name", "method_name")


_TOTALS = """totals AS (SELECT 'platforms' AS metric, count(*) AS value FROM platforms
  UNION ALL SELECT 'transactions', count(*) FROM facts
  UNION ALL SELECT 'deposits', count(*) FROM facts WHERE type = 'DEPOSIT'
  UNION ALL SELECT 'withdrawals', count(*) FROM facts WHERE type = 'WITHDRAWAL'
  UNION ALL SELECT 'successful_transactions', count(*) FROM facts WHERE status = 'SUCCESS'
  UNION ALL SELECT 'failed_transactions', count(*) FROM facts WHERE status = 'FAILED'
  UNION ALL SELECT 'anomalous_transactions', count(*) FROM facts WHERE is_anomalous
  UNION ALL SELECT 'payment_methods', count(*) FROM methods
  UNION ALL SELECT 'reviews', count(*) FROM labels
  UNION ALL SELECT 'complaints', count(*) FROM conversations
  UNION ALL SELECT 'news_articles', count(*) FROM pages)"""


def _totals(spark, sf):
    tx, platforms, methods = _star(spark, sf)
    return serving.overview_totals(platforms, methods, tx, views.table(spark, sf, "labels"),
                                   views.table(spark, sf, "conversations"), views.table(spark, sf, "pages"))


@query("overview_totals", with_ctes(f"{STAR}, {_TOTALS}", "SELECT * FROM totals"))
def overview_totals(spark, sf):
    return _totals(spark, sf)


@query("kpi_snapshot", with_ctes(f"{STAR}, {_TOTALS}", """
SELECT CASE metric WHEN 'platforms' THEN 'active_platforms' WHEN 'transactions' THEN 'ingested_transactions'
  ELSE 'flagged_fraud_alerts' END AS metric, value FROM totals
WHERE metric IN ('platforms', 'transactions', 'anomalous_transactions')"""))
def kpi_snapshot(spark, sf):
    return serving.kpi_snapshot(_totals(spark, sf))


@query("kpi_ratios", with_ctes(STAR, """
SELECT round(count(*) FILTER (is_anomalous) / greatest(count(*), 1) * 100, 1) AS anomaly_pct,
  round(count(*) FILTER (status = 'SUCCESS') / greatest(count(*), 1) * 100, 1) AS success_pct FROM facts"""))
def kpi_ratios(spark, sf):
    return serving.kpi_ratios(views.facts(spark, sf))


@query("methods_by_type", with_ctes(STAR, """
SELECT type, count(*) AS count, CAST(round(count(*) / sum(count(*)) OVER () * 100) AS INTEGER) AS share_pct
FROM methods GROUP BY type"""))
def methods_by_type(spark, sf):
    return serving.methods_by_type(views.methods(spark, sf))


@query("top_methods", with_ctes(STAR, """
, used AS (SELECT m.name, m.type AS method_type, count(t.id) AS transaction_count FROM facts t JOIN methods m ON t.method_id = m.id
  GROUP BY ALL ORDER BY transaction_count DESC, name LIMIT 10)
SELECT *, round(transaction_count / greatest(max(transaction_count) OVER (), 1) * 100, 1) AS bar_pct FROM used"""
                                .replace("\n, used", ", used", 1)))
def top_methods(spark, sf):
    tx, _, methods = _star(spark, sf)
    return serving.top_methods(tx, methods)


_USAGE = """usage AS (SELECT platform_id, method_id, m.name, m.type AS method_type, count(*) AS transaction_count,
  round(sum(CASE WHEN t.type = 'DEPOSIT' THEN amount ELSE 0 END), 2)::DOUBLE AS deposit_volume,
  round(sum(CASE WHEN t.type = 'WITHDRAWAL' THEN amount ELSE 0 END), 2)::DOUBLE AS withdrawal_volume
  FROM facts t JOIN methods m ON t.method_id = m.id GROUP BY ALL)"""


@query("platform_method_usage", with_ctes(f"{STAR}, {_USAGE}", "SELECT * FROM usage"))
def platform_method_usage(spark, sf):
    tx, _, methods = _star(spark, sf)
    return serving.platform_method_usage(tx, methods)


@query("platform_summary", with_ctes(STAR, """
SELECT p.id, count(t.id) AS total, count(*) FILTER (t.type = 'DEPOSIT') AS deposits,
  count(*) FILTER (t.type = 'WITHDRAWAL') AS withdrawals, count(*) FILTER (t.status = 'SUCCESS') AS successful,
  count(*) FILTER (t.status = 'FAILED') AS failed, count(*) FILTER (t.is_anomalous) AS anomalies,
  round(coalesce(sum(t.amount), 0), 2) AS total_volume FROM platforms p LEFT JOIN facts t ON t.platform_id = p.id GROUP BY p.id"""))
def platform_summary(spark, sf):
    tx, platforms, _ = _star(spark, sf)
    return serving.platform_summary(tx, platforms)


@query("platform_card_types", with_ctes(f"{STAR}, {_USAGE}", """
SELECT platform_id, method_type, count(*) AS methods FROM usage GROUP BY ALL"""))
def platform_card_types(spark, sf):
    tx, _, methods = _star(spark, sf)
    return serving.platform_card(serving.platform_method_usage(tx, methods), 3)[0]


@query("platform_card_top", with_ctes(f"{STAR}, {_USAGE}", """
SELECT platform_id, CAST(row_number() OVER w AS INTEGER) AS rank, name, method_type, transaction_count,
  greatest(count(*) OVER (PARTITION BY platform_id) - 3, 0) AS more_methods
FROM usage WINDOW w AS (PARTITION BY platform_id ORDER BY transaction_count DESC, name)
QUALIFY row_number() OVER w <= 3"""))
def platform_card_top(spark, sf):
    tx, _, methods = _star(spark, sf)
    return serving.platform_card(serving.platform_method_usage(tx, methods), 3)[1]


@query("recent_activity", with_ctes(STAR, """
SELECT 'TRANSACTION' AS type, t.id, strftime(t.datetime, '%Y-%m-%d %H:%M:%S') AS timestamp, p.name AS platform,
  t.type || ' via ' || m.name || ' — Status: ' || t.status AS description, 'REAL' AS data_quality
FROM facts t JOIN platforms p ON t.platform_id = p.id JOIN methods m ON t.method_id = m.id
ORDER BY t.datetime DESC, t.id DESC LIMIT 5"""))
def recent_activity(spark, sf):
    return serving.recent_activity(*_star(spark, sf))


@query("lookup_anomalies", with_ctes(STAR, """
SELECT id, ref_number, amount FROM facts WHERE is_anomalous ORDER BY id LIMIT 200 OFFSET 50"""))
def lookup_anomalies(spark, sf):
    return serving.lookup(views.facts(spark, sf).select("id", "ref_number", "amount", "is_anomalous"),
                          F.col("is_anomalous"), "id", 50, 200).drop("is_anomalous")


@query("lookup_next_page", with_ctes(STAR, """
SELECT id, ref_number, amount FROM facts WHERE is_anomalous ORDER BY id LIMIT 200 OFFSET 50"""))
def lookup_next_page(spark, sf):
    """The page behind the first fifty, found by its last key."""
    facts = views.facts(spark, sf).select("id", "ref_number", "amount", "is_anomalous")
    first = serving.page_after(facts, ["id"], None, 50, F.col("is_anomalous"))
    return serving.page_after(facts, ["id"], serving.last_key(first, ["id"]), 200, F.col("is_anomalous")).drop("is_anomalous")


@query("rule_anomaly", with_ctes(TX, "SELECT ref_number, amount > 45000 AS flagged FROM tx"))
def rule_anomaly(spark, sf):
    from paystrata.functions.parse import rule_anomaly as rule
    return views.transactions(spark, sf).select("ref_number", rule("amount").alias("flagged"))


@query("fmt_inr", with_ctes(TX, """
SELECT ref_number, CASE WHEN v >= 10000000 THEN '₹' || printf('%.1f', round(v / 10000000, 1)) || 'Cr'
  WHEN v >= 100000 THEN '₹' || printf('%.1f', round(v / 100000, 1)) || 'L'
  WHEN v >= 1000 THEN '₹' || printf('%.0f', round(v / 1000)) || 'K' ELSE '₹' || printf('%.0f', round(v)) END AS shown
FROM (SELECT ref_number, CASE o_orderkey % 4 WHEN 0 THEN amount * 100 WHEN 1 THEN amount WHEN 2 THEN amount / 100 ELSE amount / 10000 END AS v FROM tx)"""))
def fmt_inr(spark, sf):
    k = F.col("o_orderkey") % 4
    v = F.when(k == 0, F.col("amount") * 100).when(k == 1, F.col("amount")).when(
        k == 2, F.col("amount") / 100).otherwise(F.col("amount") / 10000)
    return views.transactions(spark, sf).select("ref_number", report.fmt_inr(v).alias("shown"))


# ------------------------------------------------------------------------ graph

@query("graph_nodes", with_ctes(GRAPH, """
SELECT type, id, label, round(volume, 2) AS volume, CAST(count AS BIGINT) AS count, connections, is_anomalous FROM nodes"""))
def graph_nodes(spark, sf):
    return graph.graph_nodes(views.graph_input(spark, sf)).withColumn("volume", F.round("volume", 2))


@query("node_connections", with_ctes(GRAPH, """
SELECT DISTINCT 'platform' AS type, platform AS id, method AS connected FROM g
UNION SELECT 'method', method, account FROM g UNION SELECT 'account', account, platform FROM g"""))
def node_connections(spark, sf):
    return graph.node_connections(views.graph_input(spark, sf))


@query("graph_edges", with_ctes(GRAPH, "SELECT * FROM edges"))
def graph_edges(spark, sf):
    return graph.graph_edges(views.graph_input(spark, sf))


@query("neighbours", with_ctes(GRAPH, """
SELECT source_type AS type, source AS id, target_type AS neighbour_type, target AS neighbour FROM edges
UNION SELECT target_type, target, source_type, source FROM edges"""))
def neighbours(spark, sf):
    return graph.neighbours(graph.graph_edges(views.graph_input(spark, sf)))


@query("induced_edges", with_ctes(GRAPH, """
SELECT e.* FROM edges e SEMI JOIN capped a ON e.source_type = a.type AND e.source = a.id
SEMI JOIN capped b ON e.target_type = b.type AND e.target = b.id"""))
def induced_edges(spark, sf):
    tx = views.graph_input(spark, sf)
    shown = graph.cap_nodes(graph.graph_nodes(tx))
    return graph.induced_edges(graph.graph_edges(tx), shown)


# ------------------------------------------------------------- counters, alerts

@query("null_audit", with_ctes(TX, """
SELECT count(*) AS valid_records, count(*) FILTER (o_orderkey % 10 = 0 OR o_orderkey % 15 = 0) AS null_fields_detected FROM tx"""))
def null_audit(spark, sf):
    holes = {"user_id": F.when(F.col("o_orderkey") % 10 != 0, F.col("user_id")),
             "amount": F.when(F.col("o_orderkey") % 15 != 0, F.col("amount"))}
    return quality.null_audit(views.transactions(spark, sf).withColumns(holes))


@query("quality_metrics", with_ctes(EV, """
, m AS (SELECT count(*) AS n, count(*) FILTER (event_id % 9 <> 0) AS v,
  count(DISTINCT CASE WHEN event_id % 9 <> 0 THEN ref_number END) AS d FROM ev)
SELECT n AS rows_read, n - v AS rejected_rows, v - d AS duplicate_rows, d AS rows_written FROM m""".replace("\n, m", ", m", 1)))
def quality_metrics(spark, sf):
    holes = views.events(spark, sf).withColumn("amount", F.when(F.col("event_id") % 9 != 0, F.col("amount")))
    return quality.quality_metrics(holes)


@query("run_summary", """
SELECT source AS scraper, 'https://' || source AS url, CASE WHEN n_chars > 200 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  n_chars / 1000.0::DOUBLE AS duration_seconds, CASE WHEN n_chars <= 200 THEN 'short' END AS error,
  CAST(len(string_split(text, chr(10))) AS INTEGER) AS headings_count, CAST(len(string_split(text, '. ')) AS INTEGER) AS categories_count,
  0 AS public_content_count, strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id), '%Y-%m-%d %H:%M:%S') AS timestamp FROM documents""")
def run_summary(spark, sf):
    d = views.table(spark, sf, "documents")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("doc_id"))
    runs = d.select(
        F.col("source").alias("scraper"), F.concat(F.lit("https://"), "source").alias("url"),
        F.when(F.col("n_chars") > 200, "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(F.col("n_chars") <= 200, "short").alias("error"), start.alias("start_ts"),
        (start + F.make_dt_interval(secs=(F.col("n_chars") / 1000).cast("decimal(18,6)"))).alias("end_ts"),
        F.split("text", "\n").alias("headings"), F.split("text", r"\. ").alias("categories"),
        F.lit(None).cast("array<string>").alias("public_content"))
    return quality.run_summary(runs).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("consumer_lag", """
WITH e AS (SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS pos FROM events)
SELECT topic, part AS "partition", max(pos) FILTER (pos % 7 <> 0 AND part <> 3) AS last_offset, max(pos) + 1 AS end_offset,
  max(pos) + 1 - coalesce(max(pos) FILTER (pos % 7 <> 0 AND part <> 3), 0) AS lag FROM e GROUP BY ALL""")
def consumer_lag(spark, sf):
    """Nobody has read the last partition."""
    e = views.table(spark, sf, "events").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"))
    ends = e.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return quality.consumer_lag(e.filter((F.col("offset") % 7 != 0) & (F.col("partition") != 3)), ends)


def _alert_sql(condition: str, hold: int, rates: dict[str, int] | None = None) -> str:
    columns = "".join(
        f", (max({c}) OVER r - min({c}) OVER r) / {s}.0::DOUBLE AS rate_{c}" for c, s in (rates or {}).items())
    window = f" WINDOW r AS (PARTITION BY series ORDER BY t RANGE BETWEEN {next(iter(rates.values()))} PRECEDING AND CURRENT ROW)" \
        if rates else ""
    return with_ctes(SAMPLES, f""", rated AS (SELECT *{columns} FROM samples{window}),
marked AS (SELECT *, ({condition}) AS c FROM rated)
SELECT series, t, bool_and(c) OVER h AND min(t) OVER h <= t - {hold} AS firing FROM marked
WINDOW h AS (PARTITION BY series ORDER BY t RANGE BETWEEN {hold} PRECEDING AND CURRENT ROW)""".lstrip())


_ALERTS = {
    "alert_no_flow": (quality.alert_no_flow, _alert_sql("rate_processed = 0", 300, {"processed": 3600})),
    "alert_rejections": (quality.alert_rejections, _alert_sql(
        "rate_rejected / (rate_processed + 1) * 100 > 10", 120, {"processed": 300, "rejected": 300})),
    "alert_etl_rejects": (quality.alert_etl_rejects, _alert_sql("rate_rejected > 0", 60, {"rejected": 900})),
    "alert_duplicates": (quality.alert_duplicates, _alert_sql("duplicates / (read + 1) * 100 > 15", 300)),
}


def _register_alert(name, rule, sql):
    @query(name, sql)
    def alert(spark, sf):
        return rule(views.metric_samples(spark, sf)).select("series", "t", "firing")


for _name, (_rule, _sql) in _ALERTS.items():
    _register_alert(_name, _rule, _sql)


# ----------------------------------------------------------------------- audits

_GOLD = """silver AS (SELECT * FROM tx),
channels AS (SELECT method, sum(amount) AS volume FROM tx GROUP BY method),
metrics AS (SELECT platform_name, avg(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END) AS success_rate FROM tx GROUP BY 1)"""


@query("high_risk", with_ctes(f"{TX}, {_GOLD}", "SELECT platform_name FROM metrics WHERE success_rate < 0.5"))
def high_risk(spark, sf):
    return gold.high_risk(gold.gold_platform_metrics(views.transactions(spark, sf))).select("platform_name")


@query("payment_intelligence", with_ctes(f"{TX}, {_GOLD}", """
SELECT 'total_volume' AS field, printf('%.2f', sum(volume)) AS value FROM channels
UNION ALL SELECT 'popular_methods', method FROM channels"""))
def payment_intelligence(spark, sf):
    return report.payment_intelligence(gold.gold_payment_channels(views.transactions(spark, sf)))


@query("avg_trust", with_ctes(STAR, "SELECT coalesce(avg(trust_score), 80.0) AS avg_trust_score FROM platforms"))
def avg_trust(spark, sf):
    return report.avg_trust(views.platforms(spark, sf))


_REPORT_SQL = """report AS (
SELECT 'rag_context' AS section, 'text' AS field, 'context' AS value
UNION ALL SELECT 'system_health', 'status', 'HEALTHY'
UNION ALL SELECT 'data_quality', 'valid_records', CAST(count(*) AS VARCHAR) FROM silver
UNION ALL SELECT 'data_quality', 'null_fields_detected', '0'
UNION ALL SELECT 'payment_metrics', 'total_volume', printf('%.2f', sum(volume)) FROM channels
UNION ALL SELECT 'payment_metrics', 'popular_methods', method FROM channels
UNION ALL SELECT 'risk_profile', 'high_risk_platforms', platform_name FROM metrics WHERE success_rate < 0.5
UNION ALL SELECT 'risk_profile', 'avg_trust_score', printf('%.1f', avg(trust_score)) FROM platforms)"""


def _report(spark, sf, approved: bool = True):
    tx = views.transactions(spark, sf)
    return report.audit_report(tx, gold.gold_payment_channels(tx), gold.gold_platform_metrics(tx),
                               views.platforms(spark, sf), "context", approved)


@query("audit_report", with_ctes(f"{TX}, {_GOLD}, {STAR}, {_REPORT_SQL}", "SELECT * FROM report"))
def audit_report(spark, sf):
    return _report(spark, sf)


@query("report_lines", with_ctes(f"{TX}, {_GOLD}, {STAR}, {_REPORT_SQL}", """
SELECT list_position(['rag_context', 'data_quality', 'payment_metrics', 'risk_profile', 'system_health'], section)::BIGINT AS section_no, 1 AS part,
  '* **' || array_to_string(list_transform(string_split(field, '_'), lambda w: upper(w[1]) || w[2:]), ' ') || '**: ' || value AS line FROM report
UNION ALL SELECT * FROM (VALUES (1::BIGINT, 0, '## 1. Executive Summary'), (2, 0, '## 2. Ingestion & Quality Metrics'),
  (3, 0, '## 3. Financial & Payment Metrics'), (4, 0, '## 4. Risk Profile Details'), (5, 0, '## 5. System Health')) v"""))
def report_lines(spark, sf):
    return report.report_lines(_report(spark, sf))


# --------------------------------------------------------------- index records

@query("index_records", with_ctes(f"{TX}, {_GOLD}", """
SELECT 'tx_' || ref_number AS id, 'silver_transactions' AS source, 'Transaction reference ' || ref_number || ' processed ' ||
  amount || ' INR via ' || method || ' on platform ' || platform_name || ' with status ' || status || '.' AS content FROM tx
UNION ALL SELECT 'platform_' || platform_name, 'gold_platform_metrics', 'Platform ' || platform_name || ' has processed ' || n ||
  ' transactions with a success rate of ' || printf('%.2f', round(r, 2)) || ' and risk score of ' ||
  CASE WHEN r < 0.5 THEN '80.0' ELSE '20.0' END || '.' FROM (SELECT platform_name, count(*) AS n,
    avg(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END) AS r FROM tx GROUP BY 1)"""))
def index_records(spark, sf):
    tx = views.transactions(spark, sf)
    return vector.index_records(vector.transaction_records(tx),
                                vector.platform_records(gold.gold_platform_metrics(tx)))


@query("new_records", with_ctes(TX, """
SELECT 'tx_' || ref_number AS id FROM tx WHERE o_orderkey % 3 <> 0"""))
def new_records(spark, sf):
    tx = views.transactions(spark, sf)
    every = vector.transaction_records(tx)
    indexed = vector.transaction_records(tx.filter(F.col("o_orderkey") % 3 == 0))
    return vector.new_records(every.unionByName(every), indexed).select("id")
