"""Vectors, grounding, intents and models."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from paystrata.operators import gold, ground, ml, nearest, report, serving, vector


def frame(spark, name, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"{name} string, vector array<float>")


def brute(index, queries, k, threshold):
    out = set()
    for q, qv in queries:
        d = sorted((float(((np.float32(v).astype("f8") - np.float32(qv).astype("f8")) ** 2).sum()), i) for i, v in index)
        out |= {(q, i, n + 1) for n, (dist, i) in enumerate(d[:k]) if dist <= threshold}
    return out


@pytest.mark.parametrize("block_bytes", [1 << 25, 200])
def test_search_matches_brute_force(spark, block_bytes):
    rng = np.random.RandomState(1)
    index = [(f"i{n:03d}", rng.randn(5)) for n in range(150)]
    index += [(f"copy{n:03d}", index[0][1]) for n in range(80)]  # a third of the rows are one vector
    queries = [(f"q{n}", rng.randn(5)) for n in range(20)] + [("same", index[0][1])]
    got = vector.similarity_search(frame(spark, "id", index).repartition(4), frame(spark, "query_id", queries), 4, 3.0, block_bytes)
    assert {(r["query_id"], r["id"], r["rank"]) for r in got.collect()} == brute(index, queries, 4, 3.0)


def test_bounds_leave_out_most_of_clustered_vectors(spark):
    """Nothing is lost: hits equal brute force, and measured and left-out rows make up the index."""
    rng = np.random.RandomState(2)
    places = rng.randn(12, 8) * 10
    index = [(f"i{n:04d}", places[n % 12] + 0.1 * rng.randn(8)) for n in range(600)]
    index += [(f"copy{n:03d}", index[0][1]) for n in range(300)]  # a third of the rows are one vector
    queries = [(f"q{n}", places[n % 12] + 0.1 * rng.randn(8)) for n in range(24)] + [("between", places[:2].mean(0)), ("same", index[0][1])]
    cells = nearest.Cells(frame(spark, "id", index).unionByName(spark.createDataFrame([("none", None)], "id string, vector array<float>")), 4000)
    hits, visits = cells.search(frame(spark, "query_id", queries), 5, 1e9)
    assert {(r["query_id"], r["id"], r["rank"]) for r in hits.collect()} == brute(index, queries, 5, 1e9)
    facts = {r["query_id"]: r for r in cells.skipped(visits).collect()}
    assert set(facts) == {q for q, _ in queries}
    assert all(r["measured"] + r["left_out"] == 900 for r in facts.values())
    assert sum(r["left_out"] for r in facts.values()) > 0.5 * 900 * len(queries)


def test_fewer_rows_than_asked_for_and_repeats(spark):
    index = [("a", [0.0, 0.0]), ("b", [100.0, 0.0]), ("c", [0.0, 100.0])]
    queries = [("q", [1.0, 1.0])]
    got = vector.similarity_search(frame(spark, "id", index), frame(spark, "query_id", queries), 5, 1e9).collect()
    assert {(r["query_id"], r["id"], r["rank"]) for r in got} == brute(index, queries, 5, 1e9)
    twice = vector.similarity_search(frame(spark, "id", index + index[:1]), frame(spark, "query_id", queries), 2, 1e9).collect()
    assert [(r["id"], r["rank"]) for r in sorted(twice, key=lambda r: r["rank"])] == [("a", 1), ("a", 2)]


def test_threshold_is_cut_after_top_k(spark):
    index = frame(spark, "id", [("faq_test_1", [0.1] * 384), ("far", [5.0] * 384)])
    query = frame(spark, "query_id", [("q", [0.1] * 384)])
    assert [(r["id"], r["distance"]) for r in vector.similarity_search(index, query, 1, 2.0).collect()] == [("faq_test_1", 0.0)]
    assert vector.similarity_search(index, query, 5, 2.0).count() == 1
    assert vector.similarity_search(index.limit(0), query, 5, 2.0).count() == 0
    assert vector.similarity_search(index, query.limit(0), 5, 2.0).count() == 0


def test_encoder(spark):
    texts = ["abc", "cba", "", "é🙂", None]
    df = spark.createDataFrame([(t,) for t in texts], "content string")
    seeds = [r[0] for r in df.select(vector.text_seed("content")).collect()]
    assert seeds == [sum(map(ord, str(t))) % 65535 for t in texts]
    vectors = [np.array(r["vector"]) for r in vector.encode_records(df).collect()]
    assert all(len(v) == 384 and abs(np.linalg.norm(v) - 1) < 1e-6 for v in vectors)
    assert np.array_equal(vectors[0], vectors[1])
    state = np.random.RandomState(294).randn(384)
    assert np.allclose(vectors[0], (state / np.linalg.norm(state)).astype("f4"))


def test_index_records_once(spark, tmp_path):
    faq = vector.faq_records(spark)
    index = vector.encode_records(faq.limit(2))
    fresh = vector.new_records(faq.unionByName(faq), index)
    assert fresh.count() == 2
    path = str(tmp_path / "index")
    vector.write_index(index, path)
    vector.write_index(vector.encode_records(fresh), path)
    stats = vector.index_stats(vector.read_index(spark, path)).first()
    assert tuple(stats) == (4, 384, True)


def test_context_of_the_nearest_record(spark):
    index = vector.encode_records(vector.faq_records(spark))
    asked = spark.createDataFrame([("q", vector.LAYER_FAQ[1][2])], "query_id string, text string")
    hits = vector.retrieve_context(index, asked.select("query_id", vector.encode("text").alias("vector")), 1)
    snippets = ground.gather_context(hits)
    assert snippets.first()["snippets"][0]["content"] == vector.LAYER_FAQ[1][2]
    lines = snippets.select(ground.context_lines("snippets")).first()[0]
    assert lines == f"- [FAQ] {vector.LAYER_FAQ[1][2]}"


@pytest.mark.parametrize("answer, context, ok", [
    ("", "text", False), ("text", "", False), (None, "x", False), ("12 34", "anything", True), ("the and", "zzz", True),
    ("silver layer cleaned rows", "The silver layer holds data", True), ("entirely unrelated words here", "gold volume", False),
])
def test_grounding(spark, answer, context, ok):
    df = spark.createDataFrame([(answer, context)], "answer string, context string")
    assert df.select(ground.verify_overlap("answer", "context")).first()[0] is ok


def test_label_answer(spark):
    df = spark.createDataFrame([("I do not know.", "x"), ("unrelated things", "gold volume")], "answer string, context string")
    out = ground.label_answer(df).collect()
    assert out[0]["verified"] and out[0]["labelled"] == "I do not know."
    assert not out[1]["verified"] and out[1]["labelled"].endswith(ground.WARNING)


def test_fallback_answers(spark):
    schema = "query string, snippets array<struct<source string, content string>>"
    df = spark.createDataFrame([("Explain what the Bronze layer does.", []), ("other", [("FAQ", "c1"), ("S", "c2")]), ("other", [])], schema)
    out = [r[0] for r in df.select(ground.fallback_answer("query", "snippets")).collect()]
    assert "Bronze layer" in out[0]
    assert out[1] == "Lakehouse Context Summary (Sources: FAQ, S):\n* c1\n* c2"
    assert out[2] == ground.NO_CONTEXT


@pytest.mark.parametrize("text, intent, argument", [
    ("Crawl 10cric", "scrape", ("spider", "cric10")), ("scrape it", "scrape", ("spider", "melbet")),
    ("clean up", "etl", None), ("select gold_platform", "table_query", ("table_name", "gold_platform_metrics")),
    ("is 12,500 fraud", "anomaly", ("amount", 12500.0)), ("predict", "anomaly", ("amount", 250000.0)),
    ("find similar crypto", "vector_search", ("search_term", "crypto")), ("make a pdf", "report", None),
    ("kpi please", "dashboard", None), ("hello", "answer", None),
])
def test_intents(spark, text, intent, argument):
    r = ground.route_intent(spark.createDataFrame([(text,)], "query string")).first()
    assert r["intent"] == intent
    if argument:
        assert r[argument[0]] == argument[1]


# ---------------------------------------------------------------------- models

@pytest.fixture(scope="module")
def silver(spark):
    base = spark.range(3000).withColumns({
        "ref_number": F.concat(F.lit("T"), F.col("id")), "amount": (F.pmod(F.xxhash64("id"), F.lit(3000)) + 10.0).cast("double"),
        "type": F.when(F.col("id") % 5 == 0, "WITHDRAWAL").otherwise("deposit"), "status": F.lit("SUCCESS"),
        "text_length": (F.col("id") % 90).cast("int"), "has_upi": F.lit(1),
        "has_bank": (F.col("id") % 3 == 0).cast("int"), "has_crypto": (F.col("id") % 10 == 0).cast("int")})
    return base.withColumn("amount", F.when(F.col("id") < 30, F.col("amount") * 1000).otherwise(F.col("amount"))).cache()


def test_isolation_forest_flags_the_extremes(spark, silver):
    features = ml.anomaly_features(silver)
    assert features.filter("type = 'deposit' AND type_num = 1.0").count() == 2400
    forest = ml.IsolationForest().fit(features)
    out = forest.transform(features)
    rate = ml.anomaly_rate(out).first()
    assert rate["records"] == 3000 and 0 < rate["flagged_pct"] <= 3.5
    assert out.filter("id < 30 AND prediction = -1").count() >= 27
    again = ml.IsolationForest().fit(features.repartition(7))
    assert again.threshold == pytest.approx(forest.threshold)


def test_isolation_forest_on_tiny_input(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 1.0)], "ref_number string, amount double, type_num double, status_num double")
    assert ml.IsolationForest(trees=3).fit(df).transform(df).first()["prediction"] == 1


def test_classifier_and_registry(spark, silver, tmp_path):
    train, test = ml.split(ml.classifier_features(silver))
    assert train.count() + test.count() == 3000 and 450 < test.count() < 750
    model = ml.train_classifier(train, trees=20)
    report = {r["class"]: r for r in ml.class_report(model.transform(test)).collect()}
    assert set(report) == {0, 1, 2} and all(r["f1"] > 0.95 for r in report.values())
    ml.save_model(model, str(tmp_path / "rf"))
    assert type(model).load(str(tmp_path / "rf")).getNumTrees == 20
    meta = ml.run_metadata(spark, "exp", {"trees": 20}, ["payment_classifier"]).first()
    assert meta["metrics"] == {"trees": 20.0} and meta["registered_models"][0]["stage"] == "Production"


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([(0, 1), (0, 0), (2, 1)], "category int, prediction int")
    out = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in ml.class_report(df).collect()}
    assert out == {0: (1.0, 0.5, 2), 1: (0.0, 0.0, 0), 2: (0.0, 0.0, 1)}


def test_kmeans_keeps_the_best_restart(spark, silver):
    _, best = ml.train_kmeans(silver, restarts=3)
    singles = [ml.train_kmeans(silver, restarts=1, seed=ml.SEED + r)[1] for r in range(3)]
    assert best <= min(singles) * (1 + 1e-9)


def test_audit_report(spark, silver, tmp_path):
    rows = silver.withColumns({"user_id": F.when(F.col("id") > 4, "u"), "platform_name": F.lit("P"), "method": F.lit("UPI")})
    platforms = spark.createDataFrame([(None,)], "trust_score double")
    args = (rows, gold.gold_payment_channels(rows), gold.gold_platform_metrics(rows), platforms, "ctx")
    assert report.audit_report(*args, approved=False).count() == 0
    out = report.audit_report(*args, approved=True)
    facts = {(r["section"], r["field"]): r["value"] for r in out.collect()}
    assert facts[("data_quality", "null_fields_detected")] == "5" and facts[("risk_profile", "avg_trust_score")] == "80.0"
    report.write_report(out, str(tmp_path / "r"))
    text = [r["value"] for r in spark.read.text(str(tmp_path / "r/markdown")).collect()]
    assert text[0] == "## 1. Executive Summary" and "* **Popular Methods**: UPI" in text
    stored = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "r/json")).collect()]
    assert {"section": "payment_metrics", "field": "popular_methods", "value": "UPI"} in stored


def test_worker_functions_travel_by_value(tmp_path):
    """A process without the package on its path can run a worker function."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    code = "import pickle, sys, pandas as pd; print(pickle.load(sys.stdin.buffer)(pd.Series(['abc']))[0])"
    out = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(vector._seeds), cwd=tmp_path,
                         capture_output=True, timeout=60)
    assert out.stdout.strip() == b"294", out.stderr


def test_pages_by_key_equal_pages_by_offset(spark):
    """All pages in turn, with null and repeated first keys."""
    rows = [(None if n % 7 == 0 else n % 5, n) for n in range(53)]
    df, keys = spark.createDataFrame(rows, "a int, b int").repartition(5), ["a", "b"]
    wanted, after, got = [tuple(r) for r in df.orderBy("a", "b").collect()], None, []
    while True:
        page = serving.page_after(df, keys, after, 10, F.col("b") != 11)
        after = serving.last_key(page, keys)
        if after is None:
            break
        got += [tuple(r) for r in page.collect()]
    assert got == [r for r in wanted if r[1] != 11]
