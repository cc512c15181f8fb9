"""Queries: vectors, grounding, intents and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from paystrata.operators import clusters, gold, ground, ml, nearest, vector
from paystrata.operators.validate import require_not_null
from paystrata.plans import views
from paystrata.plans.oracle import TX, TX_TEXT, with_ctes
from paystrata.plans.registry import query
from paystrata.session import materialize, scratch_path

# ----------------------------------------------------------------------- vectors


@query("similarity_search", """
WITH d AS (SELECT q.vec_id AS query_id, i.vec_id AS id,
  list_sum(list_transform(list_zip(q.embedding, i.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS dist
  FROM embeddings q, embeddings i),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, id) AS INTEGER) AS rank FROM d)
SELECT query_id, id, rank, round(dist, 6) AS distance FROM r WHERE rank <= 3 AND dist <= 1.5""")
def similarity_search(spark, sf):
    """Every vector against every vector."""
    e = views.table(spark, sf, "embeddings")
    hits = vector.similarity_search(
        e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")),
        e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")))
    return hits.withColumn("distance", F.round("distance", 6))


@query("search_accounts", """
SELECT q.vec_id AS query_id, (SELECT count(*) FROM embeddings) AS accounted, 1::BIGINT AS hits FROM embeddings q""")
def search_accounts(spark, sf):
    """Each vector asks for the nearest: rows that were measured or left out by a bound make up the index."""
    e = views.table(spark, sf, "embeddings")
    cells = nearest.Cells(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))
    hits, visits = cells.search(e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")), 1, 1.5)
    found = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
    return cells.skipped(visits).select("query_id", (F.col("measured") + F.col("left_out")).alias("accounted")).join(found, "query_id", "left")


@query("index_stats", """
SELECT count(*) AS total_vectors, CAST(max(len(embedding)) AS INTEGER) AS dimension, count(*) > 0 AS healthy FROM embeddings""")
def index_stats(spark, sf):
    return vector.index_stats(views.table(spark, sf, "embeddings").withColumnRenamed("embedding", "vector"))


@query("text_seed", """
SELECT doc_id, CAST(list_sum(list_transform(string_split(text, ''), lambda c: ord(c)::BIGINT)) % 65535 AS BIGINT) AS seed FROM documents""")
def text_seed(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", vector.text_seed("text").alias("seed"))


@query("hash_encoder")
def hash_encoder(spark, sf):
    docs = views.table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    return vector.encode_records(docs)


@query("retrieve_context")
def retrieve_context(spark, sf):
    """Messages of the users against the indexed transactions, platforms and layer notes."""
    tx = views.transactions(spark, sf)
    records = vector.index_records(
        vector.platform_records(gold.gold_platform_metrics(tx)), vector.transaction_records(tx), vector.faq_records(spark))
    asked = views.table(spark, sf, "conversations").filter(F.col("role") == "user").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        vector.encode("text").alias("vector"))
    return vector.retrieve_context(vector.encode_records(vector.spread(records)), asked).select(
        "query_id", "id", "rank", "distance", "source")


# --------------------------------------------------------------------- grounding

_TURNS = r"""turns AS (SELECT c.conv_id, c.turn, c.role, c.text AS answer,
  CASE WHEN c.conv_id % 3 = 0 THEN p.text || ' ' || c.text ELSE p.text END AS context FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1),
pairs AS (SELECT * FROM turns WHERE role = 'assistant'),
words AS (SELECT *, list_distinct(list_filter(string_split_regex(lower(answer), '[^\p{L}\p{N}_]+'), lambda w: regexp_matches(w, '^[a-z]{3,}$'))) AS aw,
  list_filter(string_split_regex(lower(coalesce(context, '')), '[^\p{L}\p{N}_]+'), lambda w: regexp_matches(w, '^[a-z]{3,}$')) AS cw FROM pairs),
kept AS (SELECT *, list_filter(aw, lambda w: NOT list_contains([""" + ", ".join(f"'{w}'" for w in ground.STOP_WORDS) + r"""], w)) AS kw FROM words),
scored AS (SELECT *, len(list_filter(kw, lambda w: list_contains(cw, w))) / len(kw) AS share FROM kept),
checked AS (SELECT *, answer <> '' AND coalesce(context, '') <> '' AND coalesce(share >= 0.25, true) AS grounded FROM scored)"""


def _pairs(spark, sf):
    """Each assistant message with the message of the turn before.

    Joined on (conversation, turn), so one conversation of any length is spread
    over all tasks, which a window per conversation is not.
    """
    talk = views.table(spark, sf, "conversations")
    return talk.filter(F.col("role") == "assistant").join(_shifted(talk, 1), ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.col("text").alias("answer"),
        # Every third conversation repeats the answer, so both outcomes occur.
        F.when(F.col("conv_id") % 3 == 0, F.concat("other", F.lit(" "), "text")).otherwise(F.col("other")).alias("context"))


def _shifted(talk, by: int):
    return talk.select("conv_id", (F.col("turn") + by).alias("turn"), F.col("text").alias("other"))


@query("verify_overlap", with_ctes(_TURNS, """
SELECT conv_id, turn, round(CASE WHEN len(kw) > 0 AND context IS NOT NULL THEN share WHEN len(kw) > 0 THEN 0 END, 6) AS share, grounded FROM checked"""))
def verify_overlap(spark, sf):
    return _pairs(spark, sf).select(
        "conv_id", "turn", F.round(ground.overlap_share("answer", F.coalesce("context", F.lit(""))), 6).alias("share"),
        ground.verify_overlap("answer", "context").alias("grounded"))


@query("label_answer", with_ctes(_TURNS, """
SELECT conv_id, turn, contains(lower(answer), 'i do not know') OR contains(lower(answer), 'lakehouse metadata') OR grounded AS verified,
  md5(CASE WHEN contains(lower(answer), 'i do not know') OR contains(lower(answer), 'lakehouse metadata') OR grounded THEN answer ELSE answer || chr(10) || chr(10) ||
  '[WARNING: This answer contains details that could not be verified against the stored database records.]' END) AS labelled FROM checked"""))
def label_answer(spark, sf):
    return ground.label_answer(_pairs(spark, sf)).select("conv_id", "turn", "verified", F.md5("labelled").alias("labelled"))


_CANNED = " ".join(
    "WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + f" THEN '{text}'"
    for words, text in ground.CANNED_ANSWERS)


@query("fallback_answer", f"""
WITH q AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN text || ' gold' WHEN 1 THEN 'Silver ' || text WHEN 2 THEN text || ' Bronze' ELSE text END AS text,
  c, role FROM (SELECT a.*, b.text AS c FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1))
SELECT conv_id, turn, md5(CASE {_CANNED} WHEN c IS NOT NULL THEN 'Lakehouse Context Summary (Sources: ' || role || ', ' || role || '):' || chr(10) || '* ' || c || chr(10) || '* ' || c
  ELSE 'I do not know based on the Lakehouse metadata. No context snippets were found matching this query.' END) AS answer FROM q""")
def fallback_answer(spark, sf):
    kind = F.col("turn") % 5
    q = (F.when(kind == 0, F.concat("text", F.lit(" gold"))).when(kind == 1, F.concat(F.lit("Silver "), "text"))
         .when(kind == 2, F.concat("text", F.lit(" Bronze"))).otherwise(F.col("text")))
    talk = views.table(spark, sf, "conversations")
    snippet = F.struct(F.col("role").alias("source"), F.col("c").alias("content"))
    rows = talk.join(_shifted(talk, -1).withColumnRenamed("other", "c"), ["conv_id", "turn"], "left").withColumn(
        "snippets", F.when(F.col("c").isNotNull(), F.array(snippet, snippet)))
    return rows.select("conv_id", "turn", F.md5(ground.fallback_answer(q, "snippets")).alias("answer"))


@query("panel_answer", "WITH q AS (SELECT conv_id, turn, lower(CASE turn % 3 WHEN 0 THEN 'postgres ' || text ELSE text END) AS q FROM conversations) SELECT conv_id, turn, CASE "
       + " ".join("WHEN " + " OR ".join(f"contains(q, '{w}')" for w in words) + f" THEN '{text}'" for words, text in ground.PANEL_ANSWERS)
       + " ELSE '" + ground.PANEL_DEFAULT.replace("'", "''") + "' END AS answer FROM q")
def panel_answer(spark, sf):
    q = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("postgres "), "text")).otherwise(F.col("text"))
    return views.table(spark, sf, "conversations").select("conv_id", "turn", ground.panel_answer(q).alias("answer"))


def _first_sql(rules, default) -> str:
    arms = " ".join("WHEN " + " OR ".join(f"contains(q, '{w}')" for w in words) + f" THEN '{name}'" for name, words in rules)
    return f"CASE {arms} ELSE '{default}' END"


_COMMANDS = ["", "Crawl 10Cric now ", "SELECT from gold_payment ", "predict fraud for 12,500 inr ", "search phonepe ", "pdf ", "kpi ", "run ETL "]


@query("route_intent", f"""
WITH q AS (SELECT conv_id, turn, lower([{', '.join(f"'{c}'" for c in _COMMANDS)}][CAST((conv_id + turn) % 8 AS INTEGER) + 1] || text) AS q FROM conversations),
r AS (SELECT *, {_first_sql(ground.INTENTS, ground.DEFAULT_INTENT)} AS intent FROM q)
SELECT conv_id, turn, intent, CASE WHEN intent = 'scrape' THEN {_first_sql(ground.SPIDERS, ground.DEFAULT_SPIDER)} END AS spider,
  CASE WHEN intent = 'table_query' THEN {_first_sql(ground.QUERY_TABLES, ground.DEFAULT_TABLE)} END AS table_name,
  CASE WHEN intent = 'anomaly' THEN coalesce(list_filter(list_transform(string_split_regex(q, '\\s+'), lambda t: TRY_CAST(replace(t, ',', '') AS DOUBLE)), lambda x: x IS NOT NULL)[1], 250000.0) END AS amount,
  CASE WHEN intent = 'vector_search' THEN {_first_sql([(t, [t]) for t in ground.SEARCH_TERMS], ground.DEFAULT_SPIDER)} END AS search_term FROM r""")
def route_intent(spark, sf):
    commands = F.array(*[F.lit(c) for c in _COMMANDS])
    q = F.concat(F.element_at(commands, ((F.col("conv_id") + F.col("turn")) % 8).cast("int") + 1), "text")
    talk = views.table(spark, sf, "conversations").select("conv_id", "turn", q.alias("query"))
    return ground.route_intent(talk).drop("query")


# ------------------------------------------------------------------------ models

def _silver(spark, sf):
    """Required fields present, and only what the models read: written once, for the fits and the scores."""
    rows = gold.enrich(require_not_null(views.transactions_with_text(spark, sf), gold.REQUIRED), extended_flags=True)
    return materialize(rows.select("ref_number", "amount", "text_length", "has_upi", "has_bank", "has_crypto"), "features")


def _report(spark, sf):
    train, test = ml.split(ml.classifier_features(_silver(spark, sf)))
    return ml.class_report(ml.train_classifier(train).transform(test))


@query("train_classifier")
def train_classifier(spark, sf):
    """Per-class report of the held-out fifth."""
    return _report(spark, sf)


@query("classifier_support", with_ctes(TX_TEXT, r"""
SELECT CASE WHEN contains(raw_text, '0x') OR regexp_matches(raw_text, '\b(bc1|[13])[a-zA-Z0-9]{25,50}\b') THEN 2
  WHEN contains(raw_text, 'IFSC') OR contains(raw_text, 'Account') THEN 1 ELSE 0 END::INTEGER AS class, count(*) AS support, true AS bounded
FROM txt WHERE substr(md5(ref_number), 1, 1) IN ('0', '1', '2') GROUP BY ALL"""))
def classifier_support(spark, sf):
    """Held-out rows of each class, which SQL can count, and that its scores are shares."""
    scores = F.col("precision").between(0, 1) & F.col("recall").between(0, 1) & F.col("f1").between(0, 1)
    return _report(spark, sf).filter("support > 0").select("class", "support", scores.alias("bounded"))


@query("report_averages", """
WITH p AS (SELECT quality AS a, toxic AS b FROM labels),
c AS (SELECT DISTINCT a AS class FROM p UNION SELECT DISTINCT b FROM p),
s AS (SELECT class, count(*) FILTER (a = class AND b = class) AS tp, count(*) FILTER (a = class) AS n, count(*) FILTER (b = class) AS k FROM c, p GROUP BY class),
m AS (SELECT n, CASE WHEN k > 0 THEN tp / k ELSE 0 END AS p, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS r FROM s),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM m)
SELECT round(sum(r * n) / sum(n), 6)::DOUBLE AS accuracy, round(avg(p), 6)::DOUBLE AS macro_precision, round(avg(r), 6)::DOUBLE AS macro_recall, round(avg(f), 6)::DOUBLE AS macro_f1,
  round(sum(p * n) / sum(n), 6)::DOUBLE AS weighted_precision, round(sum(r * n) / sum(n), 6)::DOUBLE AS weighted_recall, round(sum(f * n) / sum(n), 6)::DOUBLE AS weighted_f1,
  CAST(sum(n) AS BIGINT) AS support FROM f""")
def report_averages(spark, sf):
    out = ml.report_averages(ml.class_report(views.table(spark, sf, "labels"), "quality", "toxic"))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "support"})


@query("class_report", """
WITH p AS (SELECT quality AS a, toxic AS b FROM labels),
c AS (SELECT DISTINCT a AS class FROM p UNION SELECT DISTINCT b FROM p),
s AS (SELECT class, count(*) FILTER (a = class AND b = class) AS tp, count(*) FILTER (a = class) AS support, count(*) FILTER (b = class) AS predicted FROM c, p GROUP BY class),
m AS (SELECT class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, support FROM s)
SELECT CAST(class AS INTEGER) AS class, round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall,
  round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6)::DOUBLE AS f1, CAST(support AS BIGINT) AS support FROM m""")
def class_report(spark, sf):
    report = ml.class_report(views.table(spark, sf, "labels"), "quality", "toxic")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def _scored(spark, sf):
    """One fit; every seventh row lacks its amount."""
    rows = ml.anomaly_features(views.transactions(spark, sf)).withColumn(
        "amount", F.when(F.col("o_orderkey") % 7 != 0, F.col("amount")))
    rows = materialize(rows.select("ref_number", "status", *ml.ANOMALY_FEATURES), "features")
    forest = ml.IsolationForest().fit(rows)
    return forest, rows, materialize(forest.transform(rows), "scored")


@query("isolation_forest")
def isolation_forest(spark, sf):
    return _scored(spark, sf)[2].select("ref_number", "anomaly_score", "prediction")


@query("anomaly_rate", with_ctes(TX, """
SELECT count(*) AS records, count(*) FILTER (o_orderkey % 7 = 0) AS unscored, true AS share_in_bounds FROM tx"""))
def anomaly_rate(spark, sf):
    """Records, those that cannot be scored, and whether about three in a hundred of the others are flagged."""
    pred = _scored(spark, sf)[2]
    unscored = F.count_if(F.col("anomaly_score").isNull()).alias("unscored")
    share = ml.anomaly_rate(pred.filter("anomaly_score IS NOT NULL")).select((F.abs(F.col("flagged_pct") - 3) <= 3).alias("share_in_bounds"))
    return pred.agg(F.count(F.lit(1)).alias("records"), unscored).join(share)


@query("forest_reload", with_ctes(TX, """
SELECT status, count(*) AS records, count(*) FILTER (o_orderkey % 7 <> 0) AS equal_scores FROM tx GROUP BY status"""))
def forest_reload(spark, sf):
    """A forest that was saved and loaded gives every row the score it had."""
    forest, rows, scored = _scored(spark, sf)
    path = scratch_path(spark, "forest")
    forest.save(spark, path)
    again = ml.IsolationForest.load(spark, path).transform(scored.withColumnRenamed("anomaly_score", "before"))
    return again.groupBy("status").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("anomaly_score") == F.col("before")).alias("equal_scores"))


@query("anomaly_features", with_ctes(TX, """
SELECT ref_number, amount, CASE WHEN type = 'DEPOSIT' THEN 1.0::DOUBLE ELSE 0.0 END AS type_num, CASE WHEN status = 'SUCCESS' THEN 1.0::DOUBLE ELSE 0.0 END AS status_num FROM tx"""))
def anomaly_features(spark, sf):
    return ml.anomaly_features(views.transactions(spark, sf)).select("ref_number", *ml.ANOMALY_FEATURES)


def _clusters(spark, sf):
    silver = _silver(spark, sf)
    model, inertia = ml.train_kmeans(silver)
    return model.transform(silver).groupBy("prediction").agg(
        F.count(F.lit(1)).alias("members"), F.round(F.avg("amount"), 2).alias("mean_amount")).withColumn(
        "inertia", F.lit(inertia))


@query("kmeans")
def kmeans(spark, sf):
    """Cluster sizes and inertia of the best restart."""
    return _clusters(spark, sf)


@query("cluster_members", with_ctes(TX, "SELECT count(*) AS members, 3::BIGINT AS clusters, true AS positive FROM tx"))
def cluster_members(spark, sf):
    """Every row is in one of three clusters."""
    return _clusters(spark, sf).agg(F.sum("members").alias("members"), F.count(F.lit(1)).alias("clusters"), (F.min("inertia") > 0).alias("positive"))


_RUNS, _STEPS, _CENTRES = 4, 6, 3


def _share(run: int, number: int) -> float:
    return (2 * number + 0.5 + run / _RUNS) / (2 * _CENTRES)


def _lloyd_sql() -> str:
    """The same iterations, written out: assign every row in every run, average, repeat."""
    starts = ", ".join(f"({r}, {j}, {_share(r, j)!r}::DOUBLE)" for r in range(_RUNS) for j in range(_CENTRES))
    parts = [f"""p AS MATERIALIZED (SELECT ref_number, amount AS a, CAST(coalesce(length(raw_text), 0) AS DOUBLE) AS t FROM txt),
b AS (SELECT min(a) AS lo, max(a) AS hi FROM p),
c0 AS MATERIALIZED (SELECT run, number, lo + (hi - lo) * share AS a, 0.0::DOUBLE AS t FROM (VALUES {starts}) s(run, number, share), b)"""]
    for i in range(_STEPS + 1):
        parts.append(f"""m{i} AS MATERIALIZED (SELECT run, number, p.a, p.t, (p.a - c.a) * (p.a - c.a) + (p.t - c.t) * (p.t - c.t) AS gap FROM p, c{i} c
  QUALIFY row_number() OVER (PARTITION BY run, ref_number ORDER BY gap, number) = 1)""")
        if i < _STEPS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.run, c.number, coalesce(x.a, c.a) AS a, coalesce(x.t, c.t) AS t FROM c{i} c
  LEFT JOIN (SELECT run, number, avg(a) AS a, avg(t) AS t FROM m{i} GROUP BY ALL) x USING (run, number))""")
    return TX_TEXT + ", " + ",\n".join(parts) + f""",
best AS (SELECT run, sum(gap) AS inertia FROM m{_STEPS} GROUP BY run ORDER BY inertia, run LIMIT 1)"""


@query("kmeans_given_starts", with_ctes(_lloyd_sql(), f"""
SELECT CAST(number AS INTEGER) AS prediction, count(*) AS members, round(any_value(c.a), 3) AS centre_amount, round(any_value(c.t), 3) AS centre_length,
  round(any_value(inertia) / 1e9, 3) AS inertia
FROM best JOIN m{_STEPS} m USING (run) JOIN c{_STEPS} c USING (run, number) GROUP BY number"""))
def kmeans_given_starts(spark, sf):
    """Centres, members and inertia of the best of four runs, whose starts are spread over the amounts."""
    silver = _silver(spark, sf).select("amount", "text_length")
    low, high = silver.agg(F.min("amount"), F.max("amount")).first()
    starts = [[(low + (high - low) * _share(r, j), 0.0) for j in range(_CENTRES)] for r in range(_RUNS)]
    best = clusters.fit(silver, ml.CLUSTER_FEATURES, _CENTRES, _RUNS, ml.SEED, starts, _STEPS, 0.0)
    centres = spark.createDataFrame(
        [(j, round(float(a), 3), round(float(t), 3)) for j, (a, t) in enumerate(best.centres)],
        "prediction int, centre_amount double, centre_length double")
    return best.transform(silver).groupBy("prediction").agg(F.count(F.lit(1)).alias("members")).join(
        centres, "prediction").withColumn("inertia", F.round(F.lit(best.inertia / 1e9), 3))


@query("encoder_facts", """
WITH s AS (SELECT list_sum(list_transform(string_split(text, ''), lambda c: ord(c)::BIGINT)) % 65535 AS seed FROM documents)
SELECT count(*) AS records, 384 AS dimension, count(DISTINCT seed) AS vectors, true AS unit FROM s""")
def encoder_facts(spark, sf):
    """Equal seeds give equal vectors, others different ones, all of length one."""
    v = vector.encode_records(views.table(spark, sf, "documents").select("doc_id", F.col("text").alias("content")))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return v.agg(F.count(F.lit(1)).alias("records"), F.max(F.size("vector")).alias("dimension"),
                 F.count_distinct(F.hash("vector"), F.xxhash64("vector")).alias("vectors"), (F.max(F.abs(norm - 1)) < 1e-5).alias("unit"))


@query("index_roundtrip", """
SELECT count(*) AS total_vectors, CAST(max(len(embedding)) AS INTEGER) AS dimension, true AS healthy FROM embeddings""")
def index_roundtrip(spark, sf):
    """The index written in two parts, the second without what the first holds, and read back."""
    e = views.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.lit("given").alias("source"), F.lit("").alias("content"), F.col("embedding").alias("vector"))
    path = scratch_path(spark, "index")
    vector.write_index(e.filter("id % 3 = 0"), path)
    fresh = vector.new_records(e.drop("vector"), vector.read_index(spark, path)).select("id").join(e, "id")
    vector.write_index(fresh.select(*e.columns), path)
    return vector.index_stats(vector.read_index(spark, path))


@query("run_registry", """
SELECT 'payments' AS experiment_name, count(*)::DOUBLE AS records, ['anomaly_forest', 'payment_classifier'] AS models FROM orders""")
def run_registry(spark, sf):
    n = views.table(spark, sf, "orders").count()
    meta = ml.run_metadata(spark, "payments", {"records": n}, ["anomaly_forest", "payment_classifier"])
    return meta.select("experiment_name", F.col("metrics")["records"].alias("records"), F.transform("registered_models", lambda m: m["name"]).alias("models"))
