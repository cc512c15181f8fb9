"""Streams over a file source: ordering, lateness, replay, state and sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from paystrata.plans import views  # noqa: F401
from paystrata.sources import bronze
from paystrata.streaming import clean, metrics

RAW = "payments.raw.transactions"
TOPICS = [RAW, "payments.raw.news", "payments.clean.transactions", "payments.clean.news"]


class Feed:
    """Writes batches of messages as files with rising modification times."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, str(root), 0
        os.makedirs(f"{self.root}/in", exist_ok=True)

    def send(self, *bodies, topic=RAW):
        lines = []
        for body in bodies:
            lines.append(json.dumps({"topic": topic, "value": json.dumps(body), "partition": 0, "offset": self.n}))
            self.n += 1
        path = f"{self.root}/in/part-{self.n:05d}.json"
        with open(path, "w") as f:
            f.write("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))

    def events(self):
        return bronze.read_events(self.spark, "json", {"path": f"{self.root}/in", "maxFilesPerTrigger": "1"}, TOPICS)

    def clean(self):
        clean.start_cleaning(self.events(), self.root).awaitTermination()

    def read(self, name, schema=None):
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.root}/{name}")


def ev(ref, time, amount="10", **more):
    return {"ref_number": ref, "platform_name": "Melbet", "amount": amount, "timestamp": f"2024-01-01T{time}", **more}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_late_and_duplicate_across_batches(feed):
    feed.send(ev("A", "22:00:00"), ev("B", "21:59:50"), ev("A", "22:00:00"))
    feed.send(ev("C", "21:59:40"), ev("D", "21:59:50", amount="x"), {"data": ev("E", "22:00:01")})
    feed.send(ev("A", "22:00:02"), ev("F", "21:59:51"), ev("G", "21:59:52"))
    feed.clean()
    on_time = sorted(r["ref_number"] for r in feed.read("on_time").collect())
    assert on_time == ["A", "A", "B", "E", "G"]  # one A per batch; state drops the second
    errors = sorted(r["error"] for r in feed.read("dlq").collect())
    assert errors == ["Late event arrived after watermark. Event Time: 2024-01-01T21:59:40",
                      "Late event arrived after watermark. Event Time: 2024-01-01T21:59:51",
                      "Validation failed: amount must be numeric"]
    counts = metrics.batch_metrics(feed.spark, feed.root).agg(
        F.sum("validated"), F.sum("late_events"), F.sum("duplicates")).first()
    assert tuple(counts) == (8, 2, 1)

    clean.start_dedup(clean.read_on_time(feed.spark, feed.root), feed.root).awaitTermination()
    kept = {r["ref_number"]: r for r in feed.read("clean", clean.CLEAN_SCHEMA).collect()}
    assert sorted(kept) == ["A", "B", "E", "G"] and kept["A"]["batch"] == 0 and kept["A"]["method"] == "UPI"

    # Resumes from its checkpoint: A is still remembered.
    feed.send(ev("A", "22:00:03"), ev("H", "22:00:03", method_name="Visa", status="FAILED"))
    feed.clean()
    clean.start_dedup(clean.read_on_time(feed.spark, feed.root), feed.root).awaitTermination()
    rows = feed.read("clean", clean.CLEAN_SCHEMA).collect()
    assert sorted(r["ref_number"] for r in rows) == ["A", "B", "E", "G", "H"]
    assert [(r["method"], r["status"]) for r in rows if r["ref_number"] == "H"] == [("Visa", "FAILED")]


def test_replayed_batch_repeats_its_answer(feed):
    feed.send(ev("A", "22:00:00"))
    feed.send(ev("B", "22:00:30"), ev("C", "22:00:15"))
    feed.clean()
    schema = "topic string, value string, partition int, offset bigint"
    second = feed.spark.read.schema(schema).json(f"{feed.root}/in").filter("offset > 0")
    before = sorted(map(str, feed.read("on_time").collect())), feed.read("dlq").count()
    clean.clean_batch(second, 1, feed.root)
    assert (sorted(map(str, feed.read("on_time").collect())), feed.read("dlq").count()) == before
    assert feed.read("dlq").count() == 1


def test_metadata_takes_the_clean_topic(feed):
    feed.send({"platform_name": "Melbet", "title": "t"}, {"title": "no platform"}, topic="payments.raw.news")
    feed.clean()
    row = feed.read("metadata").first()
    assert row["topic"] == "payments.clean.news" and json.loads(row["value"])["title"] == "t"
    assert [r["error"] for r in feed.read("dlq").collect()] == ["Schema validation failed: missing platform_name"]


def test_state_forgets_after_the_period(feed):
    def run():
        clean.start_dedup(clean.read_on_time(feed.spark, feed.root), feed.root, ttl_seconds=0.001).awaitTermination()
    for second in range(2):
        feed.send(ev("A", f"22:00:0{second}"))
        feed.clean()
        run()
    assert feed.read("clean", clean.CLEAN_SCHEMA).count() == 2


def test_dedup_without_python(feed):
    feed.send(ev("A", "22:00:00"), ev("B", "22:00:00"))
    feed.clean()
    rows = clean.read_on_time(feed.spark, feed.root)
    q = (clean.stream_dedup_any(rows, ["ref_number"]).writeStream.format("parquet").option("path", f"{feed.root}/any")
         .option("checkpointLocation", f"{feed.root}/_c").trigger(availableNow=True).start())
    q.awaitTermination()
    assert feed.read("any").count() == 2


def test_streaming_windows_match_batch(feed):
    feed.send(*[ev(f"R{i}", f"22:00:{i:02d}", amount=str(i + 1)) for i in range(20)])
    feed.send(ev("end", "23:30:00"))
    feed.clean()
    listener = metrics.MetricsListener()
    feed.spark.streams.addListener(listener)
    rows = clean.with_lateness(metrics.observe_stream(clean.read_on_time(feed.spark, feed.root), "w"))
    q = (clean.tumbling_volume(rows).writeStream.format("parquet").option("path", f"{feed.root}/windows")
         .option("checkpointLocation", f"{feed.root}/_w").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = {r["window_start"]: (r["count"], r["volume"]) for r in feed.read("windows").collect()}
    batch = {r["window_start"]: (r["count"], r["volume"]) for r in clean.tumbling_volume(
        feed.read("on_time").filter("ref_number <> 'end'")).collect()}
    assert streamed == batch and sum(c for c, _ in batch.values()) == 20
    feed.spark.streams.removeListener(listener)
    for _ in range(50):
        if listener.samples:
            break
        import time
        time.sleep(0.1)
    samples = listener.frame(feed.spark)
    assert samples.filter("name = 'processed'").agg(F.sum("value")).first()[0] == 21


def test_flush_is_first_write_wins_and_replayable(feed):
    schema = clean.CLEAN_SCHEMA
    def rows(*refs):
        base = feed.spark.createDataFrame([(r, a, p, m) for r, a, p, m in refs], "ref_number string, amount double, platform_name string, method string")
        return base.withColumns({"type": F.lit("DEPOSIT"), "status": F.lit("SUCCESS"), "event_ts": F.lit("2024-01-01").cast("timestamp")})
    assert schema
    clean.flush_batch(rows(("A", 1.0, "My Site", "UPI"), ("B", 2.0, "Other", "Visa")), 0, feed.root)
    for _ in range(2):
        clean.flush_batch(rows(("A", 9.0, "My Site", "UPI"), ("C", 3.0, "Third", "UPI")), 1, feed.root)
    tx = {r["ref_number"]: r for r in clean.read_flushed(feed.spark, feed.root, "transactions").collect()}
    platforms = {r["name"]: r for r in clean.read_flushed(feed.spark, feed.root, "platforms").collect()}
    assert sorted(tx) == ["A", "B", "C"] and tx["A"]["amount"] == 1.0 and tx["A"]["user_id"] == "STREAM_USER"
    assert {n: r["id"] for n, r in platforms.items()} == {"My Site": 1, "Other": 2, "Third": 3}
    assert platforms["My Site"]["url"] == "https://mysite.com" and tx["C"]["platform_id"] == 3


def test_landing_stream(feed):
    feed.send(ev("TX_456", "10:00:00", amount="250.0", status="SUCCESS"), {"ref_number": "TX_123"},
              topic="payments.clean.transactions")
    for q in clean.start_bronze(feed.events(), feed.root):
        q.awaitTermination()
    assert bronze.read_bronze(feed.spark, f"{feed.root}/bronze").filter("platform = 'melbet'").count() == 1
    dead = feed.spark.read.json(f"{feed.root}/bronze_dlq").first()
    assert json.loads(dead["failed_payload"]) == {"ref_number": "TX_123"} and "missing required" in dead["error"]


def files_under(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_scratch_goes_and_flush_appends(feed):
    """After N batches no scratch table is left, and a batch leaves only what is new in it."""
    from paystrata.session import shared_root
    shared = f"{shared_root(feed.spark)}/paystrata"
    left = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    sizes = []
    for n in range(3):
        feed.send(*[ev(f"R{n}-{i}", f"22:00:{10 * n + i:02d}") for i in range(5)])
        feed.clean()
        batch = feed.spark.read.schema(clean.CLEAN_SCHEMA).parquet(f"{feed.root}/on_time").filter(F.col("batch") == n)
        clean.flush_batch(batch.unionByName(batch), n, feed.root)
        stored = feed.spark.read.parquet(f"{feed.root}/transactions/batch={n}")
        sizes.append((stored.count(), feed.spark.read.parquet(f"{feed.root}/platforms/batch={n}").count()))
    assert sizes == [(5, 1), (5, 0), (5, 0)]
    assert set(os.listdir(shared)) == left


def test_equal_clocks_in_two_partitions_are_not_late(spark):
    """Arrival order is the append time, so a second partition is not read after the first."""
    rows = [(f"R{p}-{i}", p, i, f"2024-01-01 10:{i:02d}:00", f"2024-01-01 10:{i:02d}:01") for p in range(2) for i in range(30)]
    df = spark.createDataFrame(rows, "ref_number string, partition int, offset bigint, e string, a string").select(
        "ref_number", "partition", "offset", F.lit(RAW).alias("topic"), F.col("e").cast("timestamp").alias("event_ts"),
        F.col("a").cast("timestamp").alias("appended"), F.col("e").alias("timestamp"), F.lit(None).cast("string").alias("scrape_timestamp"))
    assert clean.split_late(df, clean.ARRIVAL).filter("late").count() == 0


def test_replay_leaves_a_published_batch_alone(feed):
    feed.send(ev("A", "22:00:00"))
    feed.clean()
    path = f"{feed.root}/on_time/batch=0"
    before = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path)}
    clean.clean_batch(feed.spark.read.schema("topic string, value string, partition int, offset bigint").json(f"{feed.root}/in"), 0, feed.root)
    assert {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path)} == before
