"""Sources, validation, table writes and Silver/Gold on small golden rows."""

import json

import pytest
from pyspark.sql import functions as F

from paystrata.operators import dedup, dims, gold, quality, validate
from paystrata.plans import batch_etl
from paystrata.schemas import BRONZE
from paystrata.session import materialize, shared_root
from paystrata.sources import bronze, tables

SILVER = ("ref_number string, user_id string, platform_name string, amount double, method string, type string, "
          "status string, text_length int, has_upi int, has_bank int, has_crypto int")


def raw(spark, *dicts):
    text = spark.createDataFrame([(json.dumps(d),) for d in dicts], "value string")
    return bronze.parse_payload(text)


def errors(df):
    return [r["error"] for r in df.collect()]


def tx(**changes):
    return {"ref_number": "TX_1", "platform_name": "Melbet", "amount": "250.0", "status": "SUCCESS",
            "timestamp": "2024-05-01T22:00:00", **changes}


def test_shared_root_is_the_session_setting(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert materialize(spark.range(3), "t").count() == 3


def test_envelope_replaces_outer_fields(spark):
    row = raw(spark, {"scraper": "s", "platform_name": "outer", "data": {"ref_number": "A"}}).first()
    assert row["ref_number"] == "A" and row["platform_name"] is None


def test_garbage_payload_is_a_missing_field(spark):
    df = bronze.parse_payload(spark.createDataFrame([("not json",), (None,)], "value string"))
    assert errors(validate.validate_transactions(df)) == [validate.MISSING_STREAM] * 2


@pytest.mark.parametrize("change, error", [
    ({}, None),
    ({"ref_number": ""}, validate.MISSING_STREAM),
    ({"ref_number": None}, validate.MISSING_STREAM),
    ({"amount": None}, validate.MISSING_STREAM),
    ({"timestamp": None, "scrape_timestamp": "2024-05-01 10:00:00"}, None),
    ({"timestamp": ""}, validate.MISSING_STREAM),
    ({"amount": "-5.0"}, validate.NOT_POSITIVE),
    ({"amount": "0"}, validate.NOT_POSITIVE),
    ({"amount": "abc"}, validate.NOT_NUMERIC),
    ({"amount": "NaN"}, None),
    ({"timestamp": "yesterday"}, validate.BAD_TIMESTAMP),
    ({"timestamp": "2024"}, validate.BAD_TIMESTAMP),
])
def test_stream_rules(spark, change, error):
    assert errors(validate.validate_transactions(raw(spark, tx(**change)))) == [error]


def test_landing_reasons_are_distinct(spark):
    rows = raw(spark, tx(), tx(status=None, ref_number=None), tx(amount="-1"), tx(amount="x")).withColumn(
        "topic", F.lit("payments.clean.transactions"))
    out = validate.validate_landing(rows).select("reason", "error").collect()
    assert [r["reason"] for r in out] == [None, "missing_fields", "invalid_amount", "non_numeric_amount"]
    assert out[1]["error"] == validate.MISSING_LANDING + "['ref_number', 'status']"
    assert out[3]["error"] == "Validation failed: amount must be a number. Amount: x"


def test_landing_metadata_needs_a_platform_only(spark):
    rows = raw(spark, {"platform_name": "Melbet"}, {"ref_number": "x"}).withColumn("topic", F.lit("payments.clean.news"))
    assert [r["reason"] for r in validate.validate_landing(rows).collect()] == [None, "missing_platform"]


def test_dead_letter_shape(spark):
    valid, dead = validate.split_valid(validate.validate_transactions(raw(spark, tx(), {"ref_number": "TX_123"})), "s")
    row = dead.first()
    assert valid.count() == 1 and dead.columns == ["failed_payload", "error", "failed_at", "origin"]
    assert json.loads(row["failed_payload"]) == {"ref_number": "TX_123"} and row["origin"] == "s"


def test_storable_and_pushed(spark):
    rows = spark.createDataFrame(
        [("REAL", None), ("NOT_SCRAPED", None), (None, False), ("SCRAPE_FAILED", True), ("AUTH_REQUIRED", True)],
        "data_quality string, _pushed boolean")
    assert validate.storable(rows).count() == 3
    assert validate.not_pushed(rows).count() == 3


def test_bronze_layout_and_pruning(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze.write_bronze(raw(spark, tx(platform_name="1x Bet!"), tx(ref_number="B")).drop("payload"), path,
                        F.to_timestamp(F.lit("2024-01-05 10:00:00")))
    assert (tmp_path / "bronze/year=2024/month=01/day=05/platform=melbet").is_dir()
    assert (tmp_path / "bronze/year=2024/month=01/day=05/platform=1x_bet_").is_dir()
    read = bronze.read_bronze(spark, path).filter("platform = 'melbet' and day = 5")
    assert [r["ref_number"] for r in read.collect()] == ["B"]
    assert "PartitionFilters: [isnotnull(day" in read._jdf.queryExecution().toString().replace("#", " #") or \
        "PartitionFilters" in read._jdf.queryExecution().toString()


def test_bronze_indented_files(spark, tmp_path):
    folder = tmp_path / "b/year=2024/month=01/day=05/platform=melbet"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps(tx(), indent=4))
    (folder / "b.json").write_text("{ broken")
    rows = bronze.read_bronze(spark, str(tmp_path / "b"), BRONZE, multiline=True).collect()
    assert sorted(r["ref_number"] or "" for r in rows) == ["", "TX_1"]


def test_publish_keeps_set_metadata(spark):
    df = spark.createDataFrame([("T", None), ("U", "mine")], "ref_number string, _kafka_topic string")
    out = [json.loads(r["value"]) for r in bronze.publishable(df, F.lit("payments.raw.transactions")).collect()]
    assert [o["_kafka_topic"] for o in out] == ["payments.raw.transactions", "mine"]
    assert all(o["_published_at"] and o["timestamp"] for o in out)


def test_topic_of_kind(spark):
    kinds = spark.createDataFrame([("transaction",), ("payment_method",), ("Odd",)], "kind string")
    assert [r[0] for r in kinds.select(bronze.topic_of("kind")).collect()] == [
        "payments.raw.transactions", "payments.raw.payments", "payments.raw.odd"]


# ------------------------------------------------------------------- upserts

def silver(spark, *rows):
    return spark.createDataFrame(list(rows), SILVER)


OLD = ("TX_TEST_102", "USER_2", "Melbet", 200.0, "UPI", "DEPOSIT", "PENDING", 10, 1, 0, 0)
NEW = ("TX_TEST_102", "USER_2", "Melbet", 350.0, "UPI", "DEPOSIT", "SUCCESS", 10, 1, 0, 0)
INSERTED = ("TX_TEST_101", "USER_1", "Melbet", 500.0, "UPI", "DEPOSIT", "SUCCESS", 15, 1, 0, 0)


@pytest.mark.parametrize("mode", ["replace", "update"])
def test_upsert_golden(spark, mode):
    out = tables.upsert(silver(spark, OLD), silver(spark, NEW, INSERTED), ["ref_number"], mode)
    assert sorted((r["ref_number"], r["amount"], r["status"]) for r in out.collect()) == [
        ("TX_TEST_101", 500.0, "SUCCESS"), ("TX_TEST_102", 350.0, "SUCCESS")]


def test_upsert_modes_differ_on_unsupplied_columns(spark):
    part = silver(spark, NEW).select("ref_number", "amount")
    replaced = tables.upsert(silver(spark, OLD), part, ["ref_number"]).first()
    updated = tables.upsert(silver(spark, OLD), part, ["ref_number"], "update").first()
    assert (replaced["amount"], replaced["user_id"]) == (350.0, None)
    assert (updated["amount"], updated["user_id"]) == (350.0, "USER_2")


def test_update_sets_supplied_nulls(spark):
    part = spark.createDataFrame([("TX_TEST_102", None)], "ref_number string, method string")
    assert tables.upsert(silver(spark, OLD), part, ["ref_number"], "update").first()["method"] is None


def test_upsert_last_of_repeated_keys(spark):
    u = spark.createDataFrame([("K", 1.0, 1), ("K", 2.0, 2)], "ref_number string, amount double, seq int")
    out = tables.upsert(silver(spark, OLD), u, ["ref_number"], order=["seq"])
    assert {r["ref_number"]: r["amount"] for r in out.collect()} == {"TX_TEST_102": 200.0, "K": 2.0}


def test_versions_are_not_read_while_written(spark, tmp_path):
    root = str(tmp_path / "t")
    first = tables.write_version(silver(spark, OLD), root, 0)
    tables.write_version(tables.upsert(first, silver(spark, NEW), ["ref_number"]), root, 1)
    again = tables.write_version(tables.upsert(tables.read_version(spark, root, 0), silver(spark, NEW), ["ref_number"]), root, 1)
    assert [r["amount"] for r in again.collect()] == [350.0]
    assert tables.read_version(spark, root, 0).first()["amount"] == 200.0


def test_table_count(spark):
    spark.range(7).createOrReplaceTempView("counted")
    assert tables.table_count(spark, "counted").first()["rows"] == 7


def test_resolve_dim_case_insensitive_keeps_ids(spark):
    dim = spark.createDataFrame([(4, "Melbet")], "id bigint, name string")
    rows = spark.createDataFrame([(" melbet ",), ("1xBet",), ("10Cric",), (None,)], "platform string")
    out, full = dims.resolve_dim(rows, dim, "platform", "platform_id", ci=True)
    assert {r["platform"]: r["platform_id"] for r in out.collect()} == {" melbet ": 4, "10Cric": 5, "1xBet": 6, None: None}
    assert sorted((r["id"], r["name"]) for r in full.collect()) == [(4, "Melbet"), (5, "10Cric"), (6, "1xBet")]


def test_fact_defaults(spark):
    rows = spark.createDataFrame([(1, None, "bad"), (2, "Ann", "4.5")], "platform_id bigint, author string, rating string")
    out = [tuple(r) for r in tables.with_fact_defaults(rows, "review").collect()]
    assert out == [(1, "Anonymous", "", 0.0), (2, "Ann", "", 4.5)]


# ---------------------------------------------------------------------- gold

def test_gold_golden(spark):
    rows = silver(spark,
                  ("TX_A", "u", "Melbet", 100.0, "UPI", "DEPOSIT", "SUCCESS", 0, 0, 0, 0),
                  ("TX_B", "u", "Melbet", 150.0, "UPI", "DEPOSIT", "SUCCESS", 0, 0, 0, 0),
                  ("TX_C", "u", "10Cric", 500.0, "BANK", "DEPOSIT", "FAILED", 0, 0, 0, 0),
                  ("TX_D", "u", "Half", 1.0, "BANK", "DEPOSIT", "FAILED", 0, 0, 0, 0),
                  ("TX_E", "u", "Half", 1.0, "BANK", "DEPOSIT", "SUCCESS", 0, 0, 0, 0))
    channels = {r["method"]: (r["volume"], r["total_transactions"]) for r in gold.gold_payment_channels(rows).collect()}
    risk = {r["platform_name"]: r["risk_score"] for r in gold.gold_platform_metrics(rows).collect()}
    assert channels["UPI"] == (250.0, 2)
    assert risk == {"Melbet": 20.0, "10Cric": 80.0, "Half": 20.0}
    assert [r["platform_name"] for r in gold.high_risk(gold.gold_platform_metrics(rows)).collect()] == ["10Cric"]


def test_batch_load_is_idempotent(spark, tmp_path):
    rows = raw(spark, tx(raw_text="a@b IFSC"), tx(amount=None), tx(), tx(ref_number="TX_2", status="FAILED")).drop("payload")
    rows = rows.withColumn("seq", F.monotonically_increasing_id())
    root = str(tmp_path / "load")
    for version in (0, 1):
        counts = batch_etl.run(rows, root, version, [F.col("seq")]).first().asDict()
        assert counts == {"rows_read": 4, "rejected_rows": 1, "duplicate_rows": 1, "rows_written": 2}
        stored = tables.read_version(spark, f"{root}/silver", version)
        assert stored.count() == 2
    kept = {r["ref_number"]: r for r in stored.collect()}
    assert (kept["TX_1"]["has_upi"], kept["TX_1"]["has_bank"], kept["TX_1"]["text_length"]) == (1, 1, 8)
    batch_etl.rebuild(spark, stored, root, 2)
    assert tables.read_version(spark, f"{root}/gold_payment_channels", 2).count() == 1


def test_observed_counts(spark):
    df, seen = quality.observed(spark.range(10), "q", even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_dedup_sends_one_row_per_key_and_task(spark):
    """A key with most rows is cut to one row before the shuffle."""
    df = spark.range(0, 10000, 1, 4).selectExpr("if(id % 3 = 0, 0, id) AS k", "id")
    out = dedup.dedup_first(df, ["k"], [F.col("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The plan reads bottom-up: the partial limit stands below the exchange.
    exchange, partial = plan.index("Exchange hashpartitioning"), plan.index("Partial")
    assert partial > exchange and "WindowGroupLimit" in plan
    assert out.count() == 10000 - len(range(0, 10000, 3)) + 1


def test_latest_and_top(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, t int")
    assert sorted(tuple(r) for r in dedup.latest_per_key(df, ["k"], ["t"]).collect()) == [("a", 3), ("b", 2)]
