"""Queries: classifiers, identifier extraction, payload strings, pages, sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from paystrata.functions import classify, pages, parse
from paystrata.operators import quality, report, terms, validate
from paystrata.plans import views
from paystrata.plans.oracle import PAGE_TEXT, classify_sql, with_ctes
from paystrata.plans.registry import query


def _documents(spark, sf):
    return views.table(spark, sf, "documents")


# ------------------------------------------------------------------ classifiers

_NAMES = """names AS (SELECT 'part' AS kind, p_partkey AS id, p_name || ' ' || p_type AS name FROM part
  UNION ALL SELECT 'document', doc_id, text FROM documents
  UNION ALL SELECT 'message', conv_id * 1000 + turn, text FROM conversations)"""


@query("classify_method", with_ctes(_NAMES, f"""
SELECT kind, id, {classify_sql('name', 'listing')} AS listing, {classify_sql('name', 'sink')} AS sink,
  {classify_sql('name', 'sync')} AS sync FROM names"""))
def classify_method(spark, sf):
    part = views.table(spark, sf, "part").select(
        F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    docs = _documents(spark, sf).select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("name"))
    talk = views.table(spark, sf, "conversations").select(
        F.lit("message").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("name"))
    names = part.unionByName(docs).unionByName(talk)
    return names.select("kind", "id", *[classify.classify_method("name", v).alias(v) for v in classify.METHOD_KEYWORDS])


# ------------------------------------------------------------------- extraction

_ALL_TEXT = """texts AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'm', conv_id * 1000 + turn, text FROM conversations UNION ALL SELECT 'p', page_id, url || ' ' || html FROM pages)"""


def _all_text(spark, sf):
    """Every text of the given tables."""
    docs = _documents(spark, sf).select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    talk = views.table(spark, sf, "conversations").select(
        F.lit("m").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    html = views.table(spark, sf, "pages").select(
        F.lit("p").alias("kind"), F.col("page_id").alias("id"), F.concat_ws(" ", "url", "html").alias("text"))
    return docs.unionByName(talk).unionByName(html)


@query("extract_upi", with_ctes(_ALL_TEXT, r"""
SELECT kind, id, regexp_extract(text, '[a-zA-Z0-9.\-_]+@[a-zA-Z0-9]+') AS basic,
  coalesce(list_filter(regexp_extract_all(text, '[a-zA-Z0-9.\-_]{2,256}@[a-zA-Z]{2,64}'),
    lambda u: NOT regexp_matches(lower(u), 'support@|info@|help@|youremail@|domain\.com|10cric'))[1], '') AS strict,
  coalesce(list_filter(regexp_extract_all(text, '[A-Za-z0-9._-]+@[A-Za-z0-9._-]+'), lambda u: NOT ends_with(lower(u), '.com'))[1], '') AS not_com,
  regexp_extract(text, '[a-zA-Z0-9._-]+@[a-zA-Z0-9._-]+') AS "any" FROM texts"""))
def extract_upi(spark, sf):
    return _all_text(spark, sf).select(
        "kind", "id", *[classify.extract_upi("text", v).alias(v) for v in classify.UPI_PATTERNS])


@query("extract_bank", with_ctes(_ALL_TEXT, r"""
SELECT kind, id, regexp_extract(text, '[A-Z]{4}0[A-Z0-9]{6}') AS bank_ifsc_code,
  regexp_extract(text, '\b\d{9,18}\b') AS bank_account_number, regexp_extract(text, '\b[A-Z]{4}0[A-Z0-9]{6}\b') AS bounded FROM texts"""))
def extract_bank(spark, sf):
    found, bounded = classify.extract_bank("text"), classify.extract_bank("text", bounded=True)
    return _all_text(spark, sf).select("kind", "id", *[c.alias(n) for n, c in found.items()],
                                       bounded["bank_ifsc_code"].alias("bounded"))


_MADE = """made AS (SELECT event_id, CASE event_id % 5
    WHEN 0 THEN 'send to 0x' || substr(md5(CAST(event_id AS VARCHAR)) || md5(event_type), 1, 40) || ' now'
    WHEN 1 THEN 'btc 1' || translate(substr(md5(CAST(event_id AS VARCHAR)), 1, 30), '0', '2') || ' please'
    WHEN 2 THEN 'tron T' || translate(substr(md5(CAST(event_id AS VARCHAR)) || 'ab', 1, 33), '0', '3') || '.'
    WHEN 3 THEN 'bc1q' || substr(md5(CAST(event_id AS VARCHAR)) || md5(event_type), 1, 40) || ' ok'
    ELSE 'IFSC of the Account ' || props END AS text FROM events)"""


def _addresses(spark, sf):
    """Messages with wallet addresses of each network, derived from the events."""
    h = F.md5(F.col("event_id").cast("string"))
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("send to 0x"), F.substring(F.concat(h, F.md5("event_type")), 1, 40), F.lit(" now")))
        .when(kind == 1, F.concat(F.lit("btc 1"), F.translate(F.substring(h, 1, 30), "0", "2"), F.lit(" please")))
        .when(kind == 2, F.concat(F.lit("tron T"), F.translate(F.substring(F.concat(h, F.lit("ab")), 1, 33), "0", "3"), F.lit(".")))
        .when(kind == 3, F.concat(F.lit("bc1q"), F.substring(F.concat(h, F.md5("event_type")), 1, 40), F.lit(" ok")))
        .otherwise(F.concat(F.lit("IFSC of the Account "), "props")))
    return views.table(spark, sf, "events").select("event_id", text.alias("text"))


_FLAGGED = _MADE + """, flagged AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'e', event_id, text FROM made)"""


def _flagged(spark, sf):
    docs = _documents(spark, sf).select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    return docs.unionByName(_addresses(spark, sf).select(F.lit("e").alias("kind"), F.col("event_id").alias("id"), "text"))


@query("payment_flags", with_ctes(_FLAGGED, r"""
SELECT kind, id, CAST(contains(text, '@') AS INTEGER) AS has_upi, CAST(contains(text, 'IFSC') AS INTEGER) AS has_bank,
  CAST(contains(text, '0x') AS INTEGER) AS has_crypto,
  CAST(contains(text, 'IFSC') OR contains(text, 'Account') AS INTEGER) AS has_bank_ext,
  CAST(contains(text, '0x') OR regexp_matches(text, '\b(bc1|[13])[a-zA-Z0-9]{25,50}\b') AS INTEGER) AS has_crypto_ext FROM flagged"""))
def payment_flags(spark, sf):
    plain, ext = parse.payment_flags("text"), parse.payment_flags("text", extended=True)
    return _flagged(spark, sf).select(
        "kind", "id", *[c.alias(n) for n, c in plain.items()], ext["has_bank"].alias("has_bank_ext"),
        ext["has_crypto"].alias("has_crypto_ext"))


@query("category", with_ctes(_FLAGGED, """
SELECT kind, id, CASE WHEN contains(text, '0x') THEN 2 WHEN contains(text, 'IFSC') OR contains(text, 'Account') THEN 1 ELSE 0 END AS category
FROM flagged"""))
def category(spark, sf):
    flags = parse.payment_flags("text", extended=True)
    crypto = parse.payment_flags("text")["has_crypto"]
    return _flagged(spark, sf).select("kind", "id", classify.category(crypto, flags["has_bank"]).alias("category"))


@query("extract_crypto", with_ctes(_FLAGGED, r"""
, found AS (SELECT kind, id,
  regexp_extract(text, '\b(0x[a-fA-F0-9]{40}|[13][a-km-zA-HJ-NP-Z1-9]{26,33}|T[A-Za-z1-9]{33})\b') AS tron,
  regexp_extract(text, '\b(0x[a-fA-F0-9]{40}|[13][a-km-zA-HJ-NP-Z1-9]{26,33}|bc1[a-z0-9]{39,59})\b') AS bech32,
  CASE WHEN regexp_extract(text, '(?:bc1|[13])[a-zA-HJ-NP-Z0-9]{25,90}') <> '' THEN regexp_extract(text, '(?:bc1|[13])[a-zA-HJ-NP-Z0-9]{25,90}')
    ELSE regexp_extract(text, '0x[a-fA-F0-9]{40}') END AS btc_first FROM flagged)
SELECT *, CASE WHEN tron LIKE '0x%' THEN 'ERC20/USDT' WHEN tron LIKE 'T%' THEN 'TRC20/USDT' WHEN tron LIKE '1%' OR tron LIKE '3%' THEN 'BTC' ELSE '' END AS network,
  CASE WHEN btc_first LIKE 'bc1%' OR btc_first LIKE '1%' OR btc_first LIKE '3%' THEN 'BTC' WHEN btc_first LIKE '0x%' THEN 'ERC20' ELSE '' END AS network_btc_first
FROM found""".replace("\n, found", ", found", 1)))
def extract_crypto(spark, sf):
    found = _flagged(spark, sf).select("kind", "id", *[
        classify.extract_crypto("text", v).alias(v) for v in ("tron", "bech32", "btc_first")])
    return found.withColumns({"network": classify.crypto_network("tron"),
                              "network_btc_first": classify.crypto_network("btc_first", "btc_first")})


@query("match_terms", """
WITH t AS (SELECT unnest(['iCash.One', 'QR Mobile', 'Crypto', 'Crypto to', 'UPI', 'Fiat', 'Crypto to FIAT', 'QR Mobile Payments', 'the', 'The', 'und', 'est']) AS term)
SELECT doc_id, term, contains(text, term) AS exact FROM documents JOIN t ON contains(lower(text), lower(term))""")
def match_terms(spark, sf):
    exact = classify.match_terms("text", KNOWN_TERMS + COMMON_WORDS)
    loose = classify.match_terms("text", KNOWN_TERMS + COMMON_WORDS, ci=True)
    return _documents(spark, sf).select("doc_id", exact.alias("__exact"), F.explode(loose).alias("term")).select(
        "doc_id", "term", F.array_contains("__exact", F.col("term")).alias("exact"))


_DICTIONARY = r"""WITH w AS (SELECT list_filter(regexp_split_to_array(text, '[ \n]+'), lambda x: x <> '') AS w FROM benchmark),
t AS (SELECT unnest(w) AS term FROM w
  UNION SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w)"""


def _dictionary(spark, sf):
    """Words and two-word phrases of the benchmark: thousands of terms."""
    words = views.table(spark, sf, "benchmark").select(F.filter(F.split("text", "[ \\n]+"), lambda x: x != "").alias("w"))
    pairs = F.transform(F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("a"), F.slice("w", 2, F.size("w")).alias("b")),
                        lambda p: F.concat_ws(" ", p["a"], p["b"]))
    return words.filter(F.size("w") > 0).select(F.explode(F.concat("w", pairs)).alias("term"))


@query("terms_in_texts", _DICTIONARY + """
SELECT doc_id, term, CAST(strpos(text, term) AS BIGINT) AS first,
  CAST((length(text) - length(replace(text, term, ''))) // length(term) AS BIGINT) AS hits
FROM documents JOIN t ON contains(text, term)""")
def terms_in_texts(spark, sf):
    return terms.find_terms(_documents(spark, sf), "text", _dictionary(spark, sf), "term", ["doc_id"])


@query("terms_by_reach", _DICTIONARY + """
SELECT term, count(DISTINCT doc_id) AS documents, CAST(sum((length(text) - length(replace(lower(text), lower(term), ''))) // length(term)) AS BIGINT) AS hits
FROM documents JOIN t ON contains(lower(text), lower(term)) GROUP BY term""")
def terms_by_reach(spark, sf):
    """Terms in any case, by how many documents they reach."""
    found = terms.find_terms(_documents(spark, sf), "text", _dictionary(spark, sf), "term", ["doc_id"], ci=True)
    return found.groupBy("term").agg(F.count_distinct("doc_id").alias("documents"), F.sum("hits").alias("hits"))


# Payment terms of the cashier pages.
KNOWN_TERMS = ["iCash.One", "QR Mobile", "Crypto", "Crypto to", "UPI", "Fiat", "Crypto to FIAT", "QR Mobile Payments"]
COMMON_WORDS = ["the", "The", "und", "est"]


# ------------------------------------------------------------- payload strings

@query("payment_uri", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id || '@bank' END AS upi_id,
  CASE WHEN event_id % 2 = 0 THEN 'User ' || user_id END AS upi_name,
  CASE WHEN event_id % 2 = 0 THEN CAST(value AS VARCHAR) END AS amount,
  CASE WHEN event_id % 2 = 0 THEN 'T' || event_id END AS transaction_reference,
  CASE WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 4 = 0 THEN 'INR' ELSE '' END END AS currency,
  CASE WHEN event_id % 2 = 0 THEN event_type END AS note,
  CASE WHEN event_id % 2 = 1 THEN md5(CAST(event_id AS VARCHAR)) END AS crypto_token FROM events""")
def payment_uri(spark, sf):
    uri = F.concat(
        F.lit("upi://pay?pa="), F.col("user_id").cast("string"), F.lit("@bank&pn=User%20"), F.col("user_id").cast("string"),
        F.lit("&am="), F.col("value").cast("string"), F.lit("&tr=T"), F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 4 == 0, "&cu=INR").otherwise(""), F.lit("&tn="), F.col("event_type"))
    text = F.when(F.col("event_id") % 2 == 0, uri).otherwise(F.md5(F.col("event_id").cast("string")))
    parsed = views.table(spark, sf, "events").select("event_id", parse.parse_payment_uri(text).alias("u"))
    return parsed.select("event_id", "u.*")


@query("make_ref", """
SELECT event_id, 'REF_SCR_' || CASE WHEN event_id < 1000 THEN lpad(CAST(event_id AS VARCHAR), 3, '0') ELSE CAST(event_id AS VARCHAR) END
  || '_' || strftime(ts, '%H%M%S') AS ref_number, CASE WHEN event_id % 4 <> 0 THEN 'DEPOSIT' ELSE 'WITHDRAWAL' END AS type FROM events""")
def make_ref(spark, sf):
    return views.table(spark, sf, "events").select(
        "event_id", parse.make_ref("event_id", "ts").alias("ref_number"), parse.direction("event_id").alias("type"))


@query("parse_details", """
SELECT event_id, user_id || '@pay' AS upi_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id * 10 AS DOUBLE) END AS min_amount,
  CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS account FROM events""")
def parse_details(spark, sf):
    quoted = F.concat(F.lit("{'upi_id': '"), F.col("user_id").cast("string"), F.lit("@pay', 'k': "),
                      F.get_json_object("props", "$.k"), F.lit("}"))
    text = F.concat(F.lit("Deposit here. "), F.when(F.col("event_id") % 3 == 0, F.concat(
        F.lit("minimum: "), (F.col("event_id") * 10).cast("string"))).otherwise(""), F.lit(" INR. "),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("ACCOUNT  "), F.col("user_id").cast("string"))).otherwise("none"))
    rows = views.table(spark, sf, "events").select(
        "event_id", parse.parse_details(quoted, "upi_id string, k bigint").alias("d"), text.alias("text"))
    return rows.select("event_id", "d.*", parse.extract_min_amount("text").alias("min_amount"),
                       parse.extract_account("text").alias("account"))


@query("names_and_slugs", r"""
SELECT page_id, regexp_replace(lower(url), '[^a-zA-Z0-9_]', '_', 'g') AS slug, regexp_replace(url, '[^\p{L}\p{M}\p{N}\p{Pc}\-.]', '_', 'g') AS file_name,
  'https://' || lower(replace(url, ' ', '')) || '.com' AS default_url,
  CASE WHEN page_id % 2 = 0 THEN '1xBet' ELSE url END AS platform FROM pages""")
def names_and_slugs(spark, sf):
    raw = F.when(F.col("page_id") % 2 == 0, " 1XBET ").otherwise(F.concat(F.lit(" "), "url", F.lit(" ")))
    return views.table(spark, sf, "pages").select(
        "page_id", parse.slug("url").alias("slug"), parse.safe_name("url").alias("file_name"),
        parse.default_url("url").alias("default_url"), parse.canonical_platform(raw).alias("platform"))


# ------------------------------------------------------------------------- pages

def _facts(spark, sf):
    return pages.text_facts(views.table(spark, sf, "pages"))


@query("plain_text", with_ctes(PAGE_TEXT, "SELECT page_id, array_to_string(lines, chr(10)) AS plain_text FROM plain"))
def plain_text(spark, sf):
    return _facts(spark, sf).select("page_id", pages.plain_text().alias("plain_text"))


_DECODE = "replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
_COLLAPSE = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


@query("page_metadata", f"""
WITH m AS (SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title,
  CASE WHEN page_id % 4 = 1 THEN [NULL] ELSE regexp_extract_all(html, '<h1>(.*?)</h1>', 1, 's') END AS h FROM pages)
SELECT page_id, {_COLLAPSE.format(_DECODE.format('title'))} AS page_title, url AS page_url, '' AS meta_description,
  CASE WHEN x IS NOT NULL THEN 'H1' END AS tag, {_COLLAPSE.format(_DECODE.format("regexp_replace(x, '<[^>]*>', '', 'g')"))} AS heading FROM (SELECT *, unnest(h) AS x FROM m)""")
def page_metadata(spark, sf):
    # Every fourth page has no heading; it still has a row.
    bare = F.replace(F.replace(F.col("html"), F.lit("<h1>"), F.lit("<p>")), F.lit("</h1>"), F.lit("</p>"))
    html = F.when(F.col("page_id") % 4 == 1, bare).otherwise(F.col("html"))
    meta = pages.page_metadata(pages.page_facts(views.table(spark, sf, "pages").withColumn("html", html)))
    return meta.select("page_id", "page_title", "page_url", "meta_description", F.explode_outer("headings").alias("h")).select(
        "page_id", "page_title", "page_url", "meta_description", F.col("h.tag").alias("tag"), F.col("h.text").alias("heading"))


@query("reference_urls", r"""
SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) AS target FROM pages""")
def reference_urls(spark, sf):
    return views.table(spark, sf, "pages").select(
        "page_id", F.explode(pages.reference_urls("html", relative=True)).alias("target"))


# Payment blocks put into the given pages, by page number.
_BLOCKS = [
    ["<table><tr><td>Account Holder</td><td>Holder ", "{id}", "</td></tr><tr><td>Bank Name</td><td>Bank ", "{id}",
     "</td></tr></table><p>IFSC ABCD0", "{pad}", " acc 10000", "{pad}", "</p>"],
    ["<p>Payee Name: <b>Payee ", "{id}", "</b></p><p>pay user", "{id}", "@okbank today</p>"],
    ["<span>Network</span><b>TRC20 ", "{id}", "</b><p>TAbcdefghijkmnopqrstuvwxyzAB", "{pad}", "</p>"],
    ["<div class=\"payment-method\">PhonePe</div><div class=\"payment-method\" data-name=\"Skrill ", "{id}",
     "\"></div><div class=\"payment-method\">Deposit</div><div class=\"payment-method\">PhonePe</div>"],
]


def _block_sql(parts: list[str]) -> str:
    named = {"{id}": "page_id", "{pad}": "translate(lpad(CAST(page_id AS VARCHAR), 6, '1'), '0', '2')"}
    return " || ".join(named.get(p, f"'{p}'") for p in parts)


def _block(parts: list[str]):
    number = F.col("page_id").cast("string")
    named = {"{id}": number, "{pad}": F.translate(F.lpad(number, 6, "1"), "0", "2")}
    return F.concat(*[named[p] if p in named else F.lit(p) for p in parts])


_PAID = "paid AS (SELECT page_id, url, replace(html, '</article>', CASE page_id % 5 " + " ".join(
    f"WHEN {i} THEN {_block_sql(b)}" for i, b in enumerate(_BLOCKS)) + " ELSE '' END || '</article>') AS html FROM pages),\n" + \
    PAGE_TEXT.replace("FROM pages", "FROM paid")


def _paid(spark, sf):
    chain = F.when(F.col("page_id") % 5 == 0, _block(_BLOCKS[0]))
    for i, parts in enumerate(_BLOCKS[1:], 1):
        chain = chain.when(F.col("page_id") % 5 == i, _block(parts))
    html = F.replace(F.col("html"), F.lit("</article>"), F.concat(chain.otherwise(""), F.lit("</article>")))
    return views.table(spark, sf, "pages").withColumn("html", html)


_DETAILS = r"""details AS (SELECT page_id, regexp_extract(x, '[a-zA-Z0-9.\-_]+@[a-zA-Z0-9]+') AS upi_id,
  CASE page_id % 5 WHEN 1 THEN 'Payee ' || page_id ELSE '' END AS upi_name,
  CASE page_id % 5 WHEN 0 THEN 'Holder ' || page_id ELSE '' END AS bank_holder_name,
  regexp_extract(x, '\b\d{9,18}\b') AS bank_account_number, regexp_extract(x, '[A-Z]{4}0[A-Z0-9]{6}') AS bank_ifsc_code,
  CASE page_id % 5 WHEN 0 THEN 'Bank ' || page_id ELSE '' END AS bank_name,
  regexp_extract(x, '\b(0x[a-fA-F0-9]{40}|[13][a-km-zA-HJ-NP-Z1-9]{26,33}|T[A-Za-z1-9]{33})\b') AS crypto_id,
  CASE page_id % 5 WHEN 2 THEN 'TRC20 ' || page_id ELSE '' END AS crypto_value
  FROM (SELECT page_id, array_to_string(lines, chr(10)) AS x FROM plain))"""


def _details(spark, sf):
    facts = pages.text_facts(_paid(spark, sf)).withColumn("plain_text", pages.plain_text())
    return facts.select("page_id", pages.transaction_details(F.col("plain_text")).alias("d"))


@query("label_values", with_ctes(f"{_PAID}, {_DETAILS}", "SELECT * FROM details"))
def label_values(spark, sf):
    return _details(spark, sf).select("page_id", "d.*")


@query("payment_identifiers", with_ctes(f"{_PAID}, {_DETAILS}", """
SELECT page_id, upi_id <> '' OR bank_holder_name <> '' OR bank_ifsc_code <> '' OR (crypto_id <> '' AND crypto_value <> '') AS keep FROM details"""))
def payment_identifiers(spark, sf):
    return _details(spark, sf).select("page_id", pages.has_payment_identifiers("d").alias("keep"))


@query("processed_vs_valid", with_ctes(f"{_PAID}, {_DETAILS}", """
SELECT count(*) AS processed, count(*) FILTER (upi_id <> '' OR bank_holder_name <> '' OR bank_ifsc_code <> '' OR (crypto_id <> '' AND crypto_value <> '')) AS valid FROM details"""))
def processed_vs_valid(spark, sf):
    return quality.processed_vs_valid(_details(spark, sf), pages.has_payment_identifiers("d"))


@query("listing_methods", """
SELECT page_id, 0 AS pos, 'PhonePe' AS method_name, 'UPI' AS method_type, true AS deposit_supported, 'REAL' AS data_quality FROM pages WHERE page_id % 5 = 3
UNION ALL SELECT page_id, 1, 'Skrill ' || page_id, 'WALLET', true, 'REAL' FROM pages WHERE page_id % 5 = 3
UNION ALL SELECT page_id, 0, 'Not Yet Collected', 'UNKNOWN', NULL, 'NOT_SCRAPED' FROM pages WHERE page_id % 5 <> 3""")
def listing_methods(spark, sf):
    return pages.listing_methods(pages.page_facts(_paid(spark, sf)))


# The site's link list read as a listing: the selector is a parameter.
@query("listing_links", r"""
WITH x AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1, 's')) AS li, generate_subscripts(regexp_extract_all(html, '<li>(.*?)</li>', 1, 's'), 1) AS i FROM pages),
n AS (SELECT page_id, i, trim(regexp_replace(li, '<[^>]*>', '', 'g')) AS name FROM x),
f AS (SELECT page_id, name, min(i) AS i FROM n WHERE length(name) >= 2 AND lower(name) NOT IN ('deposit', 'withdraw', 'payment', 'method', 'more', 'show') GROUP BY ALL)
SELECT page_id, name AS method_name, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, 'REAL' AS data_quality, true AS deposit_supported,
  """ + classify_sql("name", "listing") + r""" AS method_type FROM f
UNION ALL SELECT page_id, 'Not Yet Collected', 0, 'NOT_SCRAPED', NULL, 'UNKNOWN' FROM pages WHERE page_id NOT IN (SELECT page_id FROM f)""")
def listing_links(spark, sf):
    facts = pages.page_facts(views.table(spark, sf, "pages"), selectors=[".payment-method", "li"])
    return pages.listing_methods(facts)


@query("page_filters", with_ctes(_PAID, r"""
, t AS (SELECT page_id, array_to_string(lines, chr(10)) AS x FROM plain)
SELECT page_id, regexp_matches(upper(x), 'BANK|ACCOUNT|PAYEE|HOLDER|AMOUNT|DEPOSIT|SUBMIT') OR regexp_matches(x, 'BTC|ETH|LTC|USDT')
  OR coalesce(len(list_filter(regexp_extract_all(x, '[A-Za-z0-9._-]+@[A-Za-z0-9._-]+'), lambda u: NOT ends_with(lower(u), '.com'))), 0) > 0 AS has_form FROM t"""
                                .replace("\n, t AS", ", t AS", 1)))
def page_filters(spark, sf):
    facts = pages.text_facts(_paid(spark, sf)).withColumn("plain_text", pages.plain_text())
    return facts.select("page_id", pages.has_payment_form(F.col("plain_text")).alias("has_form"))


@query("clean_method_names", r"""
WITH n AS (SELECT doc_id, unnest(string_split(text, ' ')) AS name FROM documents)
SELECT doc_id, count(*) AS kept FROM n WHERE length(trim(name)) >= 2 AND lower(trim(name)) NOT IN
  ('deposit', 'withdraw', 'payment', 'method', 'more', 'show', 'the', 'and') GROUP BY doc_id""")
def clean_method_names(spark, sf):
    names = _documents(spark, sf).select("doc_id", F.explode(F.split("text", " ")).alias("name"))
    return validate.clean_method_names(names, "name", ["the", "and"]).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("kept"))


# ------------------------------------------------------------------------ sheets

_ARRAYS = """arrays AS (SELECT doc_id, string_split(text, chr(10)) AS a, string_split(text, '. ') AS b, [lang, source] AS c FROM documents)"""


def _arrays(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", F.split("text", "\n").alias("a"), F.split("text", r"\. ").alias("b"), F.array("lang", "source").alias("c"))


@query("zip_pad", with_ctes(_ARRAYS, """
SELECT doc_id, CAST(i AS INTEGER) AS pos, coalesce(a[i + 1], '') AS a, coalesce(b[i + 1], '') AS b, coalesce(c[i + 1], '') AS c FROM (
  SELECT *, unnest(range(greatest(len(a), len(b), len(c)))) AS i FROM arrays)"""))
def zip_pad(spark, sf):
    return report.zip_pad(_arrays(spark, sf), ["a", "b", "c"], ["doc_id"])


@query("array_profile", with_ctes(_ARRAYS, """
SELECT doc_id, md5(array_to_string(a[1:5], '|')) AS a_sample, CAST(len(a) AS INTEGER) AS a_total, CAST(len(b) AS INTEGER) AS b_total FROM arrays"""))
def array_profile(spark, sf):
    profile = report.array_profile(_arrays(spark, sf), ["a", "b"], ["doc_id"])
    return profile.select("doc_id", F.md5(F.array_join("a_sample", "|")).alias("a_sample"), "a_total", "b_total")


@query("page_content_report", with_ctes(PAGE_TEXT, f"""
, sheet AS (SELECT page_id, list_transform(regexp_extract_all(html, '<h1>(.*?)</h1>', 1, 's'), lambda x: {_COLLAPSE.format(_DECODE.format("regexp_replace(x, '<[^>]*>', '', 'g')"))}) AS h,
  regexp_extract_all(html, 'href="([^"]*)"', 1) AS k, lines AS l FROM plain)
SELECT 'Site Page ' || page_id AS page, CAST(i AS INTEGER) AS pos, coalesce(h[i + 1], '') AS heading, coalesce(k[i + 1], '') AS category,
  coalesce(l[i + 1], '') AS content FROM (SELECT *, unnest(range(greatest(len(h), len(k), len(l)))) AS i FROM sheet)""".replace("\n, sheet", ", sheet", 1)))
def page_content_report(spark, sf):
    sheet = _facts(spark, sf).select(
        F.concat(F.lit("site_page_"), F.col("page_id").cast("string"), F.lit("_2026_x.json")).alias("file_name"),
        F.col("page.hrefs").alias("categories"), F.col("page.lines").alias("public_content"),
        F.col("page.headings").alias("headings"))
    return report.page_content_report(sheet)


@query("with_provenance", """
SELECT p_partkey AS id, 'Not Yet Collected' AS fee, 'Not Yet Collected' AS min_deposit, 'loader' AS collection_agent,
  CASE WHEN p_size % 2 = 0 THEN 'AUTH_REQUIRED' ELSE 'REAL' END AS data_quality FROM part""")
def with_provenance(spark, sf):
    rows = views.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, "AUTH_REQUIRED").alias("data_quality"))
    return report.with_provenance(rows, "loader").select("id", "fee", "min_deposit", "collection_agent", "data_quality")
