"""DuckDB twins of the views, as common table expressions."""

from __future__ import annotations

from paystrata.functions.classify import METHOD_DEFAULT, METHOD_KEYWORDS
from paystrata.plans.views import ANOMALY_LIMIT, EVENT_TOPICS, METHOD_NAMES


def case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def classify_sql(column: str, variant: str) -> str:
    arms = " ".join(f"WHEN regexp_matches(lower({column}), '{'|'.join(w)}') THEN '{k}'"
                    for k, w in METHOD_KEYWORDS[variant].items())
    return f"CASE {arms} ELSE '{METHOD_DEFAULT[variant]}' END"


METHOD = case("o_orderpriority", METHOD_NAMES)
ORDER_COLUMNS = f"""'TXN_' || o_orderkey AS ref_number, 'USR_' || o_custkey AS user_id, o_totalprice AS amount,
  {METHOD} AS method, CASE WHEN o_orderkey % 4 <> 0 THEN 'DEPOSIT' ELSE 'WITHDRAWAL' END AS type,
  CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'P' THEN 'FAILED'
       WHEN o_custkey % 2 = 0 THEN 'SUCCESS' ELSE 'PENDING' END AS status, o_orderdate AS event_ts, o_orderkey"""

TX = f"""tx AS (SELECT {ORDER_COLUMNS}, n_name AS platform_name FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

TX_TEXT = TX + """, txt AS (SELECT tx.*, text AS raw_text FROM tx LEFT JOIN documents ON doc_id = o_orderkey)"""

STAR = f"""platforms AS (
  SELECT id, name, trust_score, 'https://' || lower(replace(name, ' ', '')) || '.com' AS url FROM (
    SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS name,
           CAST(50.0 + (n_nationkey * 7) % 50 AS DOUBLE) AS trust_score FROM nation
    UNION ALL SELECT CAST(r_regionkey + 101 AS BIGINT), r_name, CAST(NULL AS DOUBLE) FROM region)),
methods AS (SELECT *, {classify_sql('name', 'sink')} AS type FROM (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id, {METHOD} AS name FROM orders)),
facts AS (SELECT o_orderkey + 1 AS id, ref_number, user_id, CAST(c_nationkey + 1 AS BIGINT) AS platform_id,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS method_id, amount, type, status,
  amount > {ANOMALY_LIMIT} AS is_anomalous, event_ts AS datetime
  FROM (SELECT {ORDER_COLUMNS}, o_custkey AS ck, o_orderpriority FROM orders) JOIN customer ON ck = c_custkey)"""

EV = """ev AS (SELECT event_id, user_id || '-' || json_extract_string(props, '$.k') AS ref_number,
  event_type AS platform_name, value AS amount, ts AS event_ts,
  ts + to_seconds(CAST((event_id * 7919) % 1201 AS BIGINT)) AS arr FROM events)"""


def raw_ev(kind: str = "raw") -> str:
    return EV + f""", raw_ev AS (SELECT event_id, arr, 'payments.{kind}.' || {case('platform_name', EVENT_TOPICS)} AS topic,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE ref_number END AS ref_number,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE platform_name END AS platform_name,
  CASE WHEN event_id % 13 = 0 THEN '0' WHEN event_id % 17 = 0 THEN 'abc' ELSE CAST(amount AS VARCHAR) END AS amount,
  CASE WHEN event_id % 19 = 0 THEN 'not-a-time' ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp,
  event_ts, CASE WHEN event_id % 29 = 0 THEN NULL ELSE 'SUCCESS' END AS status,
  CASE WHEN event_id % 7 = 0 THEN 'Visa' END AS method_name FROM ev)"""


STREAM_ERROR = """CASE WHEN coalesce(ref_number, '') = '' OR coalesce(platform_name, '') = '' THEN
  'Schema validation failed: missing ref_number, platform_name, amount, or timestamp'
  WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'Validation failed: amount must be numeric'
  WHEN CAST(amount AS DOUBLE) <= 0 THEN 'Validation failed: transaction amount must be positive'
  WHEN TRY_CAST(timestamp AS TIMESTAMP) IS NULL THEN 'Validation failed: invalid timestamp ISO format' END"""

# Valid transactions of the raw topic, late flag by running maximum, first on-time
# sight of each reference.
CLEAN = raw_ev() + f""", valid AS (SELECT *, CAST(amount AS DOUBLE) AS amt FROM raw_ev
  WHERE topic = 'payments.raw.transactions' AND {STREAM_ERROR} IS NULL),
flagged AS (SELECT *, event_ts < max(event_ts) OVER (ORDER BY arr, event_id % 3, event_id) - INTERVAL 10 SECONDS AS late FROM valid),
clean AS (SELECT * FROM flagged WHERE NOT late
  QUALIFY row_number() OVER (PARTITION BY ref_number ORDER BY arr, event_id % 3, event_id) = 1)"""

SAMPLES = EV + """, per_minute AS (SELECT platform_name AS series,
  CAST(floor(epoch(event_ts) / 60) * 60 AS BIGINT) AS t, 1000 * count(*) AS n,
  1000 * count(*) FILTER (event_id % 3 = 0) AS bad, 1000 * count(*) FILTER (event_id % 5 = 0) AS dup FROM ev GROUP BY 1, 2),
samples AS (SELECT series, t, sum(n) OVER w AS read, sum(n - bad) OVER w AS processed, sum(bad) OVER w AS rejected,
  sum(dup) OVER w AS duplicates FROM per_minute WINDOW w AS (PARTITION BY series ORDER BY t))"""

GRAPH = TX + f""", g AS (SELECT platform_name AS platform, method,
  CASE WHEN length(user_id) > 5 THEN user_id ELSE 'ACC_' || right(ref_number, 4) END AS account, amount,
  amount > {ANOMALY_LIMIT} AS is_anomalous FROM tx),
nodes AS (
  SELECT 'platform' AS type, platform AS id, platform AS label, sum(amount) AS volume, count(*) AS count,
         count(DISTINCT method) AS connections, CAST(NULL AS BOOLEAN) AS is_anomalous FROM g GROUP BY platform
  UNION ALL SELECT 'method', method, method, sum(amount), count(*), count(DISTINCT account), NULL FROM g GROUP BY method
  UNION ALL SELECT 'account', account, CASE WHEN starts_with(account, 'USR_') THEN 'UPI: ' || substr(account, 5) || '@pay'
         ELSE 'Bank: ' || account END, sum(amount), count(*), count(DISTINCT platform), bool_or(is_anomalous)
         FROM g GROUP BY account),
edges AS (SELECT DISTINCT 'platform' AS source_type, platform AS source, 'method' AS target_type, method AS target FROM g
  UNION SELECT DISTINCT 'method', method, 'account', account FROM g),
capped AS (SELECT * FROM nodes QUALIFY type = 'platform' OR row_number() OVER (
  PARTITION BY type ORDER BY round(volume, 2) DESC, id) <= CASE type WHEN 'method' THEN 8 ELSE 10 END)"""

# Visible text of a page: hidden tags and comments out, tags to line breaks,
# entities of the data decoded, lines trimmed.
PAGE_TEXT = r"""body AS (SELECT page_id, url, html, regexp_replace(regexp_replace(html,
    '<(head)>.*</head>', '', 'gs'), '<!--.*?-->', '', 'gs') AS b FROM pages),
plain AS (SELECT page_id, url, html, list_filter(list_transform(string_split(
    replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', chr(10), 'g'),
      '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), chr(10)),
    lambda x: trim(x)), lambda x: x <> '') AS lines FROM body)"""


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
