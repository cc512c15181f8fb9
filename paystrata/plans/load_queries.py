"""Queries: sources, validation, deduplication, table writes, Silver and Gold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from paystrata.functions.parse import conform, default_url, slug, to_amount
from paystrata.operators import dedup, dims, gold, prefix, quality, validate
from paystrata.plans import batch_etl, views
from paystrata.plans.oracle import CLEAN, EV, STREAM_ERROR, TX, TX_TEXT, raw_ev, with_ctes
from paystrata.plans.registry import query
from paystrata.session import materialize, scratch_path
from paystrata.sources import bronze, tables
from paystrata.streaming import clean as stream
from paystrata.streaming import guard, metrics


def _round(df, **digits):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _ts(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ------------------------------------------------------------ Silver and Gold

@query("gold_platform_metrics", with_ctes(TX, """
SELECT platform_name, count(ref_number) AS transaction_count,
  round(avg(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END), 6) AS success_rate, round(avg(amount), 6) AS avg_amount,
  CASE WHEN avg(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END) < 0.5 THEN 80.0::DOUBLE ELSE 20.0::DOUBLE END AS risk_score
FROM tx GROUP BY platform_name"""))
def gold_platform_metrics(spark, sf):
    silver = gold.to_silver(views.transactions(spark, sf).withColumn("raw_text", F.lit(None).cast("string")),
                            [F.col("event_ts"), F.col("o_orderkey")])
    return _round(gold.gold_platform_metrics(silver), success_rate=6, avg_amount=6).orderBy("platform_name")


@query("gold_payment_channels", with_ctes(TX, """
SELECT method, round(sum(amount), 2) AS volume, count(ref_number) AS total_transactions FROM (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE method END AS method, amount, ref_number FROM tx) GROUP BY method"""))
def gold_payment_channels(spark, sf):
    tx = views.transactions(spark, sf).withColumn("method", F.when(F.col("o_orderkey") % 7 != 0, F.col("method")))
    return _round(gold.gold_payment_channels(tx), volume=2)


_SILVER_SQL = """ref_number, user_id, platform_name, amount, method, type, status, CAST(coalesce(length(raw_text), 0) AS INTEGER) AS text_length,
  CAST(coalesce(contains(raw_text, '@'), false) AS INTEGER) AS has_upi,
  CAST(coalesce(contains(raw_text, 'IFSC'), false) AS INTEGER) AS has_bank,
  CAST(coalesce(contains(raw_text, '0x'), false) AS INTEGER) AS has_crypto"""


@query("silver_transactions", with_ctes(TX_TEXT, f"""
SELECT {_SILVER_SQL}, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM txt"""))
def silver_transactions(spark, sf):
    silver = gold.to_silver(views.transactions_with_text(spark, sf), [F.col("event_ts"), F.col("o_orderkey")])
    return silver.withColumn("event_time", _ts("event_ts")).select(
        *gold.SILVER_REPORT_COLUMNS, "event_time")


@query("bronze_roundtrip", with_ctes(TX, """
SELECT ref_number, user_id, platform_name, amount, method, type, status, strftime(event_ts, '%Y-%m-%dT%H:%M:%S') AS timestamp,
  'UNKNOWN' AS raw_text, regexp_replace(lower(platform_name), '[^a-zA-Z0-9_]', '_', 'g') AS platform,
  year(event_ts)::INTEGER AS year FROM tx"""))
def bronze_roundtrip(spark, sf):
    """Wire messages → parsed → partitioned JSON → read back with an explicit schema."""
    tx = views.transactions(spark, sf)
    body = F.struct("ref_number", "user_id", "platform_name", "amount", "method", "type", "status",
                    F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    parsed = bronze.parse_payload(tx.select(F.to_json(body).alias("value"))).drop("payload", "raw_text")
    path = scratch_path(spark, "bronze")
    # The year as ingest time keeps the folder count small on this data.
    bronze.write_bronze(parsed, path, F.trunc(F.to_timestamp("timestamp"), "year"))
    rows = conform(bronze.read_bronze(spark, path).withColumn("amount", to_amount("amount")).drop("raw_text"),
                   ["ref_number", "user_id", "platform_name", "amount", "method", "type", "status", "timestamp",
                    "raw_text", "platform", "year"])
    return rows


@query("export_json", with_ctes(TX, """
SELECT ref_number, amount, method, '2024-01-01 00:00:00' AS export_timestamp FROM tx"""))
def export_json(spark, sf):
    path = scratch_path(spark, "export")
    bronze.export_json(views.transactions(spark, sf).select("ref_number", "amount", "method"), path,
                       F.lit("2024-01-01 00:00:00"))
    return spark.read.schema("ref_number string, amount double, method string, export_timestamp string").json(path)


@query("publish_events", with_ctes(raw_ev(), """
SELECT topic, count(*) AS messages, count(*) FILTER (timestamp IS NOT NULL) AS stamped, count(DISTINCT topic) AS topics
FROM raw_ev GROUP BY topic"""))
def publish_events(spark, sf):
    raw = views.raw_events(spark, sf).drop("arr")
    sent = bronze.publishable(raw, F.col("topic"))
    body = F.from_json("value", "timestamp string, _kafka_topic string, _published_at string")
    return sent.withColumn("b", body).groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.count("b.timestamp").alias("stamped"),
        F.count_distinct("b._kafka_topic").alias("topics"))


@query("batch_load", with_ctes(TX_TEXT, f"""
, b AS (SELECT * REPLACE (CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE amount END AS amount) FROM txt),
v AS (SELECT * FROM b WHERE amount IS NOT NULL)
SELECT 'silver' AS name, method AS key, count(*) AS n, round(sum(amount), 2) AS total FROM v GROUP BY method
UNION ALL SELECT 'channels', method, count(*), round(sum(amount), 2) FROM v GROUP BY method
UNION ALL SELECT 'platforms', platform_name, count(*), CASE WHEN avg(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END) < 0.5 THEN 80.0 ELSE 20.0 END FROM v GROUP BY platform_name
UNION ALL SELECT 'dead', 'Missing required fields: amount', count(*), 0 FROM b WHERE amount IS NULL
UNION ALL SELECT 'read', '', count(*) + count(*) FILTER (amount IS NOT NULL), 0 FROM b
UNION ALL SELECT 'duplicate', '', count(*) FILTER (amount IS NOT NULL), 0 FROM b""".replace("\n, b AS", ", b AS", 1)))
def batch_load(spark, sf):
    """The batch load twice, with every row delivered twice in the first run."""
    tx = views.transactions_with_text(spark, sf).withColumn(
        "amount", F.when(F.col("o_orderkey") % 11 != 0, F.col("amount")))
    root, order = scratch_path(spark, "load"), [F.col("event_ts"), F.col("o_orderkey")]
    twice = tx.unionByName(tx.filter(F.col("amount").isNotNull()))
    first = batch_etl.run(twice, root, 0, order)
    batch_etl.run(tx, root, 1, order)
    silver, channels, platforms = (tables.read_version(spark, f"{root}/{n}", 1) for n in (
        "silver", "gold_payment_channels", "gold_platform_metrics"))
    zero = F.lit(0.0)
    parts = [
        silver.groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("t")).select(
            F.lit("silver").alias("name"), F.col("method").alias("key"), "n", F.round("t", 2).alias("total")),
        channels.select(F.lit("channels"), "method", "total_transactions", F.round("volume", 2)),
        platforms.select(F.lit("platforms"), "platform_name", "transaction_count", "risk_score"),
        spark.read.schema("error string").json(f"{root}/dlq/v=1").groupBy("error").agg(
            F.count(F.lit(1)).alias("n")).select(F.lit("dead"), "error", "n", zero),
        first.select(F.lit("read"), F.lit(""), "rows_read", zero),
        first.select(F.lit("duplicate"), F.lit(""), "duplicate_rows", zero)]
    return reduce(lambda a, b: a.union(b), parts)


# ----------------------------------------------------------------- validation

@query("stream_validation_reasons", with_ctes(raw_ev(), f"""
SELECT topic, reason, count(*) AS rejected FROM (SELECT topic, {STREAM_ERROR} AS reason FROM raw_ev)
WHERE reason IS NOT NULL GROUP BY ALL"""))
def stream_validation_reasons(spark, sf):
    checked = validate.validate_transactions(views.raw_events(spark, sf))
    return quality.rejections_by_reason(checked.filter(F.col("error").isNotNull()))


@query("dead_letters", with_ctes(raw_ev(), f"""
SELECT event_id, {STREAM_ERROR} AS error, 'stream-cleaning-stage' AS origin FROM raw_ev WHERE error IS NOT NULL"""))
def dead_letters(spark, sf):
    raw = views.raw_events(spark, sf)
    _, dead = validate.split_valid(validate.validate_transactions(raw), stream.ORIGIN)
    return dead.select(F.get_json_object("failed_payload", "$.event_id").cast("bigint").alias("event_id"),
                       "error", "origin")


_LANDING_META = "split_part(topic, '.', 3) <> 'transactions'"
_LANDING_SQL = f"""SELECT event_id, topic, CASE WHEN {_LANDING_META} THEN
    CASE WHEN platform_name IS NULL THEN 'Validation failed: missing platform_name' END
  WHEN ref_number = '' OR platform_name IS NULL OR status IS NULL THEN
    'Validation failed: missing required transactional fields: [' || array_to_string(list_filter([
      CASE WHEN ref_number = '' THEN '''ref_number''' END, CASE WHEN platform_name IS NULL THEN '''platform_name''' END,
      CASE WHEN status IS NULL THEN '''status''' END], lambda x: x IS NOT NULL), ', ') || ']'
  WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'Validation failed: amount must be a number. Amount: ' || amount
  WHEN CAST(amount AS DOUBLE) <= 0 THEN 'Validation failed: transaction amount must be positive. Amount: ' || amount
  END AS error FROM raw_ev"""


@query("landing_validation", with_ctes(raw_ev("clean"), f"SELECT * FROM ({_LANDING_SQL}) WHERE error IS NOT NULL"))
def landing_validation(spark, sf):
    checked = validate.validate_landing(views.raw_events(spark, sf, "clean"))
    return checked.filter(F.col("error").isNotNull()).select("event_id", "topic", "error")


@query("landing_rejection_counts", with_ctes(raw_ev("clean"), f"""
SELECT topic, CASE WHEN error LIKE '%missing platform_name' THEN 'missing_platform' WHEN error LIKE '%fields%' THEN 'missing_fields'
  WHEN error LIKE '%number%' THEN 'non_numeric_amount' ELSE 'invalid_amount' END AS reason, count(*) AS rejected
FROM ({_LANDING_SQL}) WHERE error IS NOT NULL GROUP BY ALL"""))
def landing_rejection_counts(spark, sf):
    checked = validate.validate_landing(views.raw_events(spark, sf, "clean"))
    return quality.rejections_by_reason(checked.filter(F.col("reason").isNotNull()), reason="reason")


@query("item_validation", with_ctes(raw_ev(), """
, items AS (SELECT *, CASE split_part(topic, '.', 3) WHEN 'transactions' THEN 'transaction' WHEN 'payments' THEN 'payment_method'
    ELSE 'other' END AS kind FROM raw_ev)
SELECT kind, CASE WHEN kind = 'transaction' THEN
    CASE WHEN ref_number = '' OR platform_name IS NULL THEN 'TransactionItem missing required fields'
         WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'Amount not a number: ' || amount
         WHEN CAST(amount AS DOUBLE) <= 0 THEN 'Amount must be positive: ' || amount END
  WHEN kind = 'payment_method' AND (platform_name IS NULL OR method_name IS NULL)
    THEN 'PaymentMethodItem missing platform_name or method_name' END AS error, count(*) AS items
FROM items WHERE event_id % 4 NOT IN (0, 1) AND event_id % 6 <> 0 GROUP BY ALL""".replace("\n, items", ", items", 1)))
def item_validation(spark, sf):
    """Item rules, then only storable and not yet published rows are counted."""
    kind = (F.when(F.col("topic").endswith("transactions"), "transaction")
            .when(F.col("topic").endswith("payments"), "payment_method").otherwise("other"))
    marks = F.when(F.col("event_id") % 4 == 0, "NOT_SCRAPED").when(F.col("event_id") % 4 == 1, "SCRAPE_FAILED") \
        .when(F.col("event_id") % 4 == 2, "REAL")
    items = views.raw_events(spark, sf).withColumns({
        "kind": kind, "data_quality": marks, "_pushed": F.when(F.col("event_id") % 6 == 0, True)})
    rows = validate.not_pushed(validate.storable(validate.validate_items(items)))
    return rows.groupBy("kind", "error").agg(F.count(F.lit(1)).alias("items"))


@query("metadata_route", with_ctes(raw_ev(), """
SELECT replace(topic, '.raw.', '.clean.') AS topic, CASE WHEN platform_name IS NULL THEN
  'Schema validation failed: missing platform_name' END AS error, count(*) AS events
FROM raw_ev WHERE topic <> 'payments.raw.transactions' GROUP BY ALL"""))
def metadata_route(spark, sf):
    parsed = bronze.parse_payload(views.wire(views.raw_events(spark, sf)))
    _, metadata = validate.route(parsed)
    return validate.validate_metadata(metadata).groupBy("topic", "error").agg(F.count(F.lit(1)).alias("events"))


# ------------------------------------------------------------------- keyed rows

_EV_OUT = ["event_id", "ref_number", "platform_name", "amount"]


@query("dedup_first", with_ctes(EV, """SELECT event_id, ref_number, platform_name, amount FROM ev
QUALIFY row_number() OVER (PARTITION BY ref_number ORDER BY arr, event_id) = 1"""))
def dedup_first(spark, sf):
    return dedup.dedup_first(views.events(spark, sf), ["ref_number"], [F.col("arr"), F.col("event_id")]).select(*_EV_OUT)


@query("latest_per_key", with_ctes(EV, """SELECT event_id, ref_number, platform_name, amount FROM ev
QUALIFY row_number() OVER (PARTITION BY ref_number ORDER BY arr DESC, event_id DESC) = 1"""))
def latest_per_key(spark, sf):
    return dedup.latest_per_key(views.events(spark, sf), ["ref_number"], ["arr", "event_id"]).select(*_EV_OUT)


@query("running_volume", with_ctes(EV, """
SELECT event_id, round(sum(amount) OVER (ORDER BY arr, event_id), 2) AS cumulative FROM ev"""))
def running_volume(spark, sf):
    events = views.events(spark, sf).select("arr", "event_id", "amount")
    return _round(prefix.running_volume(events, ["arr", "event_id"]).select("event_id", "cumulative"), cumulative=2)


@query("late_flags", with_ctes(EV, """SELECT event_id,
event_ts < max(event_ts) OVER (ORDER BY arr, event_id) - INTERVAL 10 SECONDS AS late FROM ev"""))
def late_flags(spark, sf):
    events = views.events(spark, sf).select("arr", "event_id", "event_ts")
    return prefix.late_flags(events, ["arr", "event_id"]).select("event_id", "late")


@query("assign_ids", with_ctes(EV, """
SELECT ref_number, row_number() OVER (ORDER BY ref_number) + 100 AS id FROM (SELECT DISTINCT ref_number FROM ev)"""))
def assign_ids(spark, sf):
    names = views.events(spark, sf).select("ref_number").distinct()
    return dims.assign_ids(names, "ref_number", 100).select("ref_number", "id")


# ----------------------------------------------------------------- table writes

_KEYED = "SELECT ref_number, user_id, amount, status, method, o_orderkey AS k FROM tx"


def _keyed(spark, sf):
    tx = views.transactions(spark, sf).select(
        "ref_number", "user_id", "amount", "status", "method", F.col("o_orderkey").alias("k"))
    return tx.filter(F.col("k") % 3 != 0).drop("k"), tx.filter(F.col("k") % 3 != 1)


@query("upsert_replace", with_ctes(TX, f"""
, t AS ({_KEYED})
SELECT ref_number, CASE WHEN k % 3 <> 1 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN k % 3 <> 1 THEN amount * 2 ELSE amount END AS amount, CASE WHEN k % 3 <> 1 THEN 'SUCCESS' ELSE status END AS status,
  CASE WHEN k % 3 <> 1 THEN NULL ELSE method END AS method FROM t""".replace("\n, t AS", ", t AS", 1)))
def upsert_replace(spark, sf):
    target, updates = _keyed(spark, sf)
    new = updates.select("ref_number", (F.col("amount") * 2).alias("amount"), F.lit("SUCCESS").alias("status"))
    return tables.upsert(target, new, ["ref_number"])


@query("upsert_update", with_ctes(TX, f"""
, t AS ({_KEYED})
SELECT ref_number, CASE WHEN k % 3 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN k % 3 <> 1 THEN amount * 2 ELSE amount END AS amount, CASE WHEN k % 3 <> 1 THEN 'SUCCESS' ELSE status END AS status,
  CASE WHEN k % 3 = 0 THEN NULL ELSE method END AS method FROM t""".replace("\n, t AS", ", t AS", 1)))
def upsert_update(spark, sf):
    target, updates = _keyed(spark, sf)
    new = updates.select("ref_number", (F.col("amount") * 2).alias("amount"), F.lit("SUCCESS").alias("status"))
    return tables.upsert(target, new, ["ref_number"], mode="update")


@query("upsert_repeated_keys", """
WITH t AS (SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT coalesce(o_orderkey, l_orderkey) AS key, coalesce(l_quantity, o_totalprice) AS amount,
  coalesce(l_returnflag, o_orderstatus) AS status FROM orders FULL OUTER JOIN t ON o_orderkey = l_orderkey""")
def upsert_repeated_keys(spark, sf):
    target = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))
    updates = views.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_quantity").alias("amount"), F.col("l_returnflag").alias("status"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return tables.upsert(target, updates, ["key"],
                         order=["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


@query("insert_if_absent", """
WITH target AS (SELECT o_orderkey AS key, o_totalprice AS amount FROM orders WHERE o_orderkey % 2 = 0),
incoming AS (SELECT l_orderkey AS key, l_extendedprice AS amount FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1)
SELECT * FROM target UNION ALL SELECT * FROM incoming ANTI JOIN target USING (key)""")
def insert_if_absent(spark, sf):
    target = views.table(spark, sf, "orders").filter(F.col("o_orderkey") % 2 == 0).select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    new = views.table(spark, sf, "lineitem").withColumns({"key": F.col("l_orderkey"), "amount": F.col("l_extendedprice")})
    return tables.insert_if_absent(target, new, ["key"], [
        F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")])


@query("resolve_dim", with_ctes(TX, """
, names AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN '  ' || upper(method) ELSE method END AS raw FROM tx),
keyed AS (SELECT lower(trim(raw)) AS key, min(trim(raw)) AS name, count(*) AS transactions FROM names GROUP BY 1),
dim AS (SELECT * FROM (VALUES (7, 'phonepe', 'PhonePe'), (9, 'visa', 'Visa')) v(id, key, name)),
fresh AS (SELECT key, name, 9 + row_number() OVER (ORDER BY name) AS id FROM keyed ANTI JOIN dim USING (key))
SELECT CAST(coalesce(dim.id, fresh.id) AS BIGINT) AS id, coalesce(dim.name, fresh.name) AS name, transactions,
  CASE WHEN fresh.id IS NOT NULL THEN 'https://' || lower(replace(fresh.name, ' ', '')) || '.com' END AS url
FROM keyed LEFT JOIN dim USING (key) LEFT JOIN fresh USING (key)""".replace("\n, names", ", names", 1)))
def resolve_dim(spark, sf):
    tx = views.transactions(spark, sf).withColumn("method", F.when(
        F.col("o_orderkey") % 3 == 0, F.concat(F.lit("  "), F.upper("method"))).otherwise(F.col("method")))
    known = views.methods(spark, sf).filter(F.col("name").isin("PhonePe", "Visa")).select(
        F.when(F.col("name") == "PhonePe", 7).otherwise(9).cast("bigint").alias("id"), "name",
        F.lit(None).cast("string").alias("url"))
    rows, full = dims.resolve_dim(tx, known, "method", "method_id", ci=True, extra={"url": default_url("name")})
    counts = rows.groupBy(F.col("method_id").alias("id")).agg(F.count(F.lit(1)).alias("transactions"))
    return full.join(counts, "id")


@query("append_facts", """
SELECT CAST(doc_id % 25 + 1 AS BIGINT) AS platform_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END, 'Anonymous') AS author,
  coalesce(CAST(quality AS DOUBLE), 0.0) AS rating, md5(text) AS content FROM documents LEFT JOIN labels USING (doc_id)""")
def append_facts(spark, sf):
    rows = views.table(spark, sf, "documents").join(views.table(spark, sf, "labels"), "doc_id", "left").select(
        "lang", (F.col("doc_id") % 25 + 1).alias("platform_id"), F.col("quality").cast("string").alias("rating"),
        F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("author"), F.col("text").alias("content"))
    stored = tables.with_fact_defaults(rows.filter(F.col("lang") == "en"), "review")
    return tables.append_facts(stored, rows.filter(F.col("lang") != "en"), "review").withColumn(
        "content", F.md5("content"))


@query("complaints_and_news", """
SELECT 'complaint' AS kind, CAST(conv_id % 25 + 1 AS BIGINT) AS platform_id, coalesce(CASE WHEN role = 'user' THEN role END, 'No Subject') AS title,
  md5(text) AS body, 'UNRESOLVED' AS extra FROM conversations
UNION ALL SELECT 'news', CAST(page_id % 25 + 1 AS BIGINT), '', md5(html), 'Web Scraper' FROM pages""")
def complaints_and_news(spark, sf):
    c = views.table(spark, sf, "conversations").select(
        (F.col("conv_id") % 25 + 1).alias("platform_id"), F.when(F.col("role") == "user", F.col("role")).alias("title"),
        F.col("text").alias("description"))
    n = views.table(spark, sf, "pages").select(
        (F.col("page_id") % 25 + 1).alias("platform_id"), F.col("html").alias("content"), "url")
    left = tables.with_fact_defaults(c, "complaint").select(
        F.lit("complaint").alias("kind"), "platform_id", "title", F.md5("description").alias("body"), F.col("status").alias("extra"))
    right = tables.with_fact_defaults(n, "news").select(
        F.lit("news").alias("kind"), "platform_id", "title", F.md5("content").alias("body"), F.col("source").alias("extra"))
    return left.unionByName(right)


@query("delete_cascade", """
SELECT 'customer' AS name, c_custkey AS key FROM customer WHERE NOT c_acctbal < 0
UNION ALL SELECT 'orders', o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT c_acctbal < 0""")
def delete_cascade(spark, sf):
    customer, orders = views.table(spark, sf, "customer"), views.table(spark, sf, "orders")
    left = tables.delete_cascade({"customer": customer, "orders": orders}, "customer", "c_custkey",
                                 customer.filter(F.col("c_acctbal") < 0), {"orders": "o_custkey"})
    return left["customer"].select(F.lit("customer").alias("name"), F.col("c_custkey").alias("key")).unionByName(
        left["orders"].select(F.lit("orders").alias("name"), F.col("o_orderkey").alias("key")))


# -------------------------------------------------------------------- streaming

@query("tumbling_volume", with_ctes(EV, """
SELECT strftime(time_bucket(INTERVAL '5 seconds', event_ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS count,
  round(sum(amount), 2) AS volume FROM ev GROUP BY 1"""))
def tumbling_volume(spark, sf):
    return _round(stream.tumbling_volume(views.events(spark, sf)), volume=2).select(
        _ts("window_start").alias("window_start"), "count", "volume")


def _feed(spark, sf, root: str, kind: str = "raw"):
    """The wire messages of three log partitions as three sets of files, one after the other."""
    numbered = prefix.row_numbers(views.wire(views.raw_events(spark, sf, kind)), ["arr", "event_id"], "offset")
    appended = F.date_format("arr", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    raw = materialize(numbered.select("topic", "value", (F.col("event_id") % 3).cast("int").alias("partition"), "offset",
                                      appended.alias("appended"), "arr"), "feed")
    low, high = raw.agg(F.min("arr"), F.max("arr")).first()
    step = (high - low) / 3
    for i in range(3):
        start, end = low + step * i, (low + step * (i + 1) if i < 2 else None)
        part = raw.filter((F.col("arr") >= F.lit(start)) & (F.col("arr") < F.lit(end) if end else F.lit(True)))
        part.drop("arr").write.mode("append").json(f"{root}/in")
        yield i


def _events(spark, root: str, kind: str = "raw"):
    topics = [f"payments.{kind}.{t}" for t in views.EVENT_TOPICS.values()]
    return bronze.read_events(spark, "json", {"path": f"{root}/in"}, topics)


@query("clean_stream", with_ctes(CLEAN, """
SELECT ref_number, platform_name, amt AS amount, coalesce(method_name, 'UPI') AS method, 'DEPOSIT' AS type,
  coalesce(status, 'SUCCESS') AS status, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time FROM clean"""))
def clean_stream(spark, sf):
    """Both streaming queries over three batches that resume from their checkpoints."""
    root = scratch_path(spark, "stream")
    for _ in _feed(spark, sf, root):
        stream.start_cleaning(_events(spark, root), root).awaitTermination()
        stream.start_dedup(stream.read_on_time(spark, root), root).awaitTermination()
    return spark.read.schema(stream.CLEAN_SCHEMA).parquet(f"{root}/clean").withColumn(
        "event_time", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).drop(
        "event_ts", "batch", *stream.ARRIVAL)


@query("stream_dead_letters", with_ctes(CLEAN, f"""
SELECT error, count(*) AS rejected FROM (
  SELECT {STREAM_ERROR} AS error FROM raw_ev WHERE topic = 'payments.raw.transactions' AND error IS NOT NULL
  UNION ALL SELECT 'Schema validation failed: missing platform_name' FROM raw_ev
    WHERE topic <> 'payments.raw.transactions' AND platform_name IS NULL
  UNION ALL SELECT 'Late event arrived after watermark. Event Time: ' || timestamp FROM flagged WHERE late) GROUP BY error"""))
def stream_dead_letters(spark, sf):
    root = scratch_path(spark, "stream")
    for _ in _feed(spark, sf, root):
        stream.start_cleaning(_events(spark, root), root).awaitTermination()
    dead = spark.read.parquet(f"{root}/dlq")
    return dead.groupBy("error").agg(F.count(F.lit(1)).alias("rejected"))


@query("stream_flush", with_ctes(CLEAN, """
SELECT p.name AS platform_name, 'https://' || lower(replace(p.name, ' ', '')) || '.com' AS url, coalesce(method_name, 'UPI') AS method,
  count(*) AS transactions, round(sum(amt), 2) AS volume, 'STREAM_USER' AS user_id
FROM clean JOIN (SELECT DISTINCT platform_name AS name FROM clean) p ON p.name = platform_name GROUP BY ALL"""))
def stream_flush(spark, sf):
    """Cleaning, dedup and the window flush into the star tables."""
    root = scratch_path(spark, "stream")
    for _ in _feed(spark, sf, root):
        stream.start_cleaning(_events(spark, root), root).awaitTermination()
    stream.start_dedup(stream.read_on_time(spark, root), root).awaitTermination()
    clean = spark.readStream.schema(stream.CLEAN_SCHEMA).parquet(f"{root}/clean")
    done = stream.start_flush(clean, root, {"availableNow": True})
    done.awaitTermination()
    tx, platforms, methods = (stream.read_flushed(spark, root, n) for n in ("transactions", "platforms", "payment_methods"))
    p = platforms.select(F.col("id").alias("platform_id"), F.col("name").alias("platform_name"), "url")
    m = methods.select(F.col("id").alias("method_id"), F.col("name").alias("method"))
    return tx.join(p, "platform_id").join(m, "method_id").groupBy("platform_name", "url", "method", "user_id").agg(
        F.count(F.lit(1)).alias("transactions"), F.round(F.sum("amount"), 2).alias("volume"))


@query("poison_pills", with_ctes(EV, """
, last AS (SELECT max(event_id) AS id FROM ev)
SELECT 'clean' AS sink, platform_name AS key, count(*) AS n, round(sum(amount), 2) AS total FROM ev, last WHERE event_id <> id GROUP BY ALL
UNION ALL SELECT 'topics', CASE platform_name WHEN 'view' THEN 'transactions' WHEN 'click' THEN 'payments' WHEN 'error' THEN 'complaints'
  WHEN 'purchase' THEN 'reviews' ELSE 'news' END, count(*), 0 FROM ev, last WHERE event_id <> id GROUP BY ALL
UNION ALL SELECT 'dlq', 'CAST_INVALID_INPUT', 1, 0""".replace("\n, last", ", last", 1)))
def poison_pills(spark, sf):
    """A strict stream with one payload that raises: it alone ends in the dead letters."""
    root, schemas = scratch_path(spark, "guarded"), {"clean": "platform_name string, amount double", "topics": "topic string"}
    events = views.events(spark, sf)
    last = events.agg(F.max("event_id")).first()[0]
    raw = views.raw_events(spark, sf).select("event_id", "arr", "topic").join(events.select("event_id", "platform_name", "amount"), "event_id")
    body = F.to_json(F.struct("platform_name", F.when(F.col("event_id") == last, "12,5").otherwise(F.col("amount").cast("string")).alias("amount")))
    numbered = prefix.row_numbers(raw.select("topic", body.alias("value"), "arr", "event_id"), ["arr", "event_id"], "offset")
    kept = materialize(numbered.select("topic", "value", F.lit(0).alias("partition"), "offset"), "feed")
    half = kept.agg(F.max("offset")).first()[0] // 2

    def strict(df):
        parsed = bronze.parse_payload(df)
        return {"clean": parsed.select("platform_name", F.col("amount").cast("double").alias("amount")),
                "topics": parsed.select(F.element_at(F.split("topic", "[.]"), -1).alias("topic"))}

    for part in (kept.filter(F.col("offset") <= half), kept.filter(F.col("offset") > half)):
        part.write.mode("append").json(f"{root}/in")
        guard.start_guarded(_events(spark, root), root, schemas, strict, stream.ORIGIN, attempts=2, wait=0.1).awaitTermination()
    read = lambda name: guard.read_guarded(spark, root, schemas, name)
    zero, one = F.lit(0.0), F.count(F.lit(1)).alias("n")
    return (read("clean").groupBy("platform_name").agg(one, F.round(F.sum("amount"), 2).alias("total")).select(
                F.lit("clean").alias("sink"), F.col("platform_name").alias("key"), "n", "total")
            .unionAll(read("topics").groupBy("topic").agg(one).select(F.lit("topics"), "topic", "n", zero))
            .unionAll(read("dlq").groupBy(F.regexp_extract("error", r"\[([A-Z_]+)", 1).alias("e")).agg(one).select(F.lit("dlq"), "e", "n", zero)))


@query("bronze_stream", with_ctes(raw_ev("clean"), f"""
SELECT coalesce(e.ref_number, '') AS ref_number, e.platform_name, lower(e.platform_name) AS platform, count(*) AS landed
FROM raw_ev e JOIN ({_LANDING_SQL}) l USING (event_id) WHERE l.error IS NULL GROUP BY ALL"""))
def bronze_stream(spark, sf):
    root = scratch_path(spark, "landing")
    for _ in _feed(spark, sf, root, "clean"):
        for q in stream.start_bronze(_events(spark, root, "clean"), root):
            q.awaitTermination()
    return bronze.read_bronze(spark, f"{root}/bronze").groupBy(
        F.coalesce("ref_number", F.lit("")).alias("ref_number"), "platform_name", "platform").agg(
        F.count(F.lit(1)).alias("landed"))


@query("stream_passthrough", with_ctes(raw_ev("raw"), """
SELECT replace(topic, '.raw.', '.clean.') AS topic, platform_name, count(*) AS events FROM raw_ev
WHERE topic <> 'payments.raw.transactions' AND platform_name IS NOT NULL GROUP BY ALL"""))
def stream_passthrough(spark, sf):
    root = scratch_path(spark, "passthrough")
    for _ in _feed(spark, sf, root):
        (stream.passthrough(_events(spark, root)).writeStream.format("json").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/_checkpoints/out").trigger(availableNow=True).start().awaitTermination())
    out = spark.read.schema("topic string, value string").json(f"{root}/out")
    parsed = bronze.parse_payload(out)
    return parsed.groupBy("topic", "platform_name").agg(F.count(F.lit(1)).alias("events"))


@query("stream_windows", with_ctes(CLEAN, """
SELECT strftime(time_bucket(INTERVAL '5 seconds', event_ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS count, round(sum(amt), 2) AS volume
FROM clean GROUP BY 1"""))
def stream_windows(spark, sf):
    """The tumbling windows as a stream over the cleaned one."""
    root = scratch_path(spark, "windows")
    for _ in _feed(spark, sf, root):
        stream.start_cleaning(_events(spark, root), root).awaitTermination()
        stream.start_dedup(stream.read_on_time(spark, root), root).awaitTermination()
    rows = spark.readStream.schema(stream.CLEAN_SCHEMA).parquet(f"{root}/clean")
    (stream.tumbling_volume(stream.with_lateness(rows)).writeStream.outputMode("complete")
     .foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{root}/by_window/batch={i}"))
     .option("checkpointLocation", f"{root}/_checkpoints/windows").trigger(availableNow=True).start().awaitTermination())
    out = spark.read.parquet(f"{root}/by_window")
    last = out.agg(F.max("batch")).first()[0]
    return _round(out.filter(F.col("batch") == last), volume=2).select(_ts("window_start").alias("window_start"), "count", "volume")


@query("stream_metrics", with_ctes(CLEAN, """
SELECT (SELECT count(*) FROM valid) AS validated, (SELECT count(*) FROM flagged WHERE late) AS late_events, true AS consistent"""))
def stream_metrics(spark, sf):
    """The counters that the cleaning batches left."""
    root = scratch_path(spark, "stream")
    for _ in _feed(spark, sf, root):
        stream.start_cleaning(_events(spark, root), root).awaitTermination()
    m = metrics.batch_metrics(spark, root)
    return m.agg(F.sum("validated").alias("validated"), F.sum("late_events").alias("late_events"),
                 (F.min("duplicates") >= 0).alias("consistent"))


@query("table_count", "SELECT count(*) AS rows FROM orders")
def table_count(spark, sf):
    views.table(spark, sf, "orders").createOrReplaceTempView("paystrata_orders")
    return tables.table_count(spark, "paystrata_orders")


@query("rebuild_layers", with_ctes(TX, """
SELECT 'channels' AS name, method AS key, count(*) AS n FROM tx GROUP BY method
UNION ALL SELECT 'platforms', platform_name, count(*) FROM tx GROUP BY platform_name
UNION ALL SELECT 'silver', '', count(*) FROM tx"""))
def rebuild_layers(spark, sf):
    """Silver replaced and both Gold tables recomputed from it."""
    root = scratch_path(spark, "rebuild")
    silver = gold.to_silver(views.transactions(spark, sf).withColumn("raw_text", F.lit(None).cast("string")), [F.col("event_ts"), F.col("o_orderkey")])
    batch_etl.rebuild(spark, silver, root, 0)
    read = lambda name: tables.read_version(spark, f"{root}/{name}", 0)
    return (read("gold_payment_channels").select(F.lit("channels").alias("name"), F.col("method").alias("key"), F.col("total_transactions").alias("n"))
            .unionAll(read("gold_platform_metrics").select(F.lit("platforms"), "platform_name", "transaction_count"))
            .unionAll(read("silver").agg(F.count(F.lit(1)).alias("n")).select(F.lit("silver"), F.lit(""), "n")))
