"""Answer grounding, canned answers and intent routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.parse import _col

# Word lists, texts and thresholds.
STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "if", "then", "else", "to", "of", "in", "on", "at", "for", "with",
    "is", "was", "were", "be", "been", "have", "has", "had", "do", "does", "did", "this", "that", "these",
    "those", "i", "you", "he", "she", "it", "we", "they",
]
MIN_OVERLAP = 0.25
UNKNOWN_PHRASES = ["i do not know", "lakehouse metadata"]
WARNING = ("\n\n[WARNING: This answer contains details that could not be verified against the stored "
           "database records.]")
CANNED_ANSWERS = [
    (["anomaly", "contamination"],
     "Based on the Lakehouse metadata, the Isolation Forest ML model is configured with a 3% contamination "
     "factor to flag payment anomalies."),
    (["bronze"],
     "According to the system documentation, the Bronze layer stores raw unvalidated JSON payloads directly "
     "emitted from scrapy producers."),
    (["silver"],
     "The Silver layer database contains deduplicated, cleaned, and type-validated relational schemas inside "
     "PostgreSQL."),
    (["gold"],
     "The Gold layer aggregates transaction metrics like payment channel success rates and user profit-loss "
     "indicators."),
]
# The rules of the chat panel, which answers without a context.
PANEL_ANSWERS = [
    (["anomaly", "contamination"],
     "Based on local vector context, the Isolation Forest model uses a 3% contamination factor to evaluate "
     "transactions."),
    (["silver", "postgres"],
     "The Silver layer database contains deduplicated, cleaned, and type-validated relational schemas inside "
     "PostgreSQL."),
    (["bronze"],
     "The Bronze layer stores raw unvalidated JSON payloads directly emitted from scrapy/playwright producers."),
    (["platforms"], "Registered platforms in the database include Melbet, 1xBet, 10Cric, and 22play."),
]
PANEL_DEFAULT = ("I checked the FAISS index but couldn't find matching records. Try asking about the 'medallion "
                 "layers' or 'anomaly model configuration'.")
NO_CONTEXT = "I do not know based on the Lakehouse metadata. No context snippets were found matching this query."
SUMMARY_HEAD = "Lakehouse Context Summary (Sources: "
INTENTS = [
    ("scrape", ["scrape", "crawl", "spider"]),
    ("etl", ["etl", "process data", "clean"]),
    ("table_query", ["query table", "sql", "select"]),
    ("anomaly", ["anomaly", "predict", "fraud"]),
    ("vector_search", ["vector", "similar", "search"]),
    ("report", ["report", "pdf"]),
    ("dashboard", ["dashboard", "kpi", "status"]),
]
DEFAULT_INTENT = "answer"
SPIDERS = [("cric10", ["10cric", "cric"]), ("bet22", ["22play", "bet22"])]
DEFAULT_SPIDER = "melbet"
QUERY_TABLES = [("gold_platform_metrics", ["gold_platform"]), ("gold_payment_channels", ["gold_payment"])]
DEFAULT_TABLE = "silver_transactions"
SEARCH_TERMS = ["1xbet", "10cric", "22play", "phonepe", "upi", "crypto"]
DEFAULT_AMOUNT = 250000.0


def words(c: Column | str) -> Column:
    """Distinct lower-case words of three or more ASCII letters, whole words only."""
    parts = F.split(F.lower(_col(c)), r"[^\p{L}\p{N}_]+")
    return F.array_distinct(F.filter(parts, lambda w: w.rlike("^[a-z]{3,}$")))


def overlap_share(answer: Column | str, context: Column | str) -> Column:
    """Share of the answer's keywords that the context text holds; null without any."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    keywords = F.array_except(words(answer), stop)
    found = F.size(F.array_intersect(keywords, words(context)))
    return F.when(F.size(keywords) > 0, found / F.size(keywords))


def verify_overlap(answer: Column | str, context: Column | str) -> Column:
    """Empty answer or context is unverified; an answer without keywords is verified."""
    a, c = _col(answer), _col(context)
    given = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(c, F.lit("")) != "")
    return given & F.coalesce(overlap_share(a, c) >= MIN_OVERLAP, F.lit(True))


def label_answer(df: DataFrame, answer: str = "answer", context: str = "context") -> DataFrame:
    """Adds ``verified`` and ``labelled``; an unverified answer gets the warning."""
    low = F.lower(answer)
    unsure = F.lit(False)
    for phrase in UNKNOWN_PHRASES:
        unsure = unsure | low.contains(phrase)
    return df.withColumn("verified", unsure | verify_overlap(answer, context)).withColumn(
        "labelled", F.when(F.col("verified"), F.col(answer)).otherwise(F.concat(F.col(answer), F.lit(WARNING))))


def _contains_any(text: Column, needles: list[str]) -> Column:
    test = text.contains(needles[0])
    for word in needles[1:]:
        test = test | text.contains(word)
    return test


def _first_rule(text: Column, rules: list[tuple[str, list[str]]], default: str | None) -> Column:
    chain = None
    for result, needles in rules:
        test = _contains_any(text, needles)
        chain = F.when(test, result) if chain is None else chain.when(test, result)
    return chain.otherwise(F.lit(default))


def context_lines(snippets: Column | str) -> Column:
    """``- [source] content`` per snippet of an array of structs."""
    return F.array_join(F.transform(_col(snippets), lambda s: F.concat(
        F.lit("- ["), s["source"], F.lit("] "), s["content"])), "\n")


def context_summary(snippets: Column | str) -> Column:
    """Sources and contents of the retrieved snippets, in rank order."""
    s = _col(snippets)
    sources = F.array_join(F.transform(s, lambda x: x["source"]), ", ")
    lines = F.array_join(F.transform(s, lambda x: F.concat(F.lit("* "), x["content"])), "\n")
    return F.concat(F.lit(SUMMARY_HEAD), sources, F.lit("):\n"), lines)


def gather_context(hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Top-k hits to one array of (source, content) per query; k bounds the array."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "source", "content")))
    return hits.groupBy(query_id).agg(F.transform(
        ranked, lambda r: F.struct(r["source"].alias("source"), r["content"].alias("content"))).alias("snippets"))


def fallback_answer(query: Column | str, snippets: Column | str) -> Column:
    """Canned answer by topic word, else the context summary, else no answer."""
    q, s = F.lower(_col(query)), _col(snippets)
    rules = [(text, needles) for needles, text in CANNED_ANSWERS]
    return F.coalesce(_first_rule(q, rules, None),
                      F.when(F.coalesce(F.size(s), F.lit(0)) > 0, context_summary(s)),
                      F.lit(NO_CONTEXT))


def panel_answer(query: Column | str) -> Column:
    return _first_rule(F.lower(_col(query)), [(text, needles) for needles, text in PANEL_ANSWERS], PANEL_DEFAULT)


def _strip_commas(token: Column) -> Column:
    return F.replace(token, F.lit(","), F.lit(""))


def first_number(text: Column) -> Column:
    """First blank-separated token that is a number, commas ignored."""
    tokens = F.transform(F.split(text, r"\s+"), lambda t: _strip_commas(t).try_cast("double"))
    return F.try_element_at(F.filter(tokens, lambda x: x.isNotNull()), F.lit(1))


def route_intent(df: DataFrame, query: str = "query") -> DataFrame:
    """Adds ``intent`` and the argument of the chosen tool as text."""
    q = F.lower(query)
    search = F.coalesce(
        F.try_element_at(F.filter(F.array(*[F.lit(t) for t in SEARCH_TERMS]),
                                  lambda t: F.contains(q, t)), F.lit(1)), F.lit(DEFAULT_SPIDER))
    amount = F.coalesce(first_number(q), F.lit(DEFAULT_AMOUNT))
    out = df.withColumn("intent", _first_rule(q, INTENTS, DEFAULT_INTENT))
    intent = F.col("intent")
    return out.withColumns({
        "spider": F.when(intent == "scrape", _first_rule(q, SPIDERS, DEFAULT_SPIDER)),
        "table_name": F.when(intent == "table_query", _first_rule(q, QUERY_TABLES, DEFAULT_TABLE)),
        "amount": F.when(intent == "anomaly", amount),
        "search_term": F.when(intent == "vector_search", search)})
