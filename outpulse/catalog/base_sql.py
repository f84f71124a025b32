"""DuckDB twins of the adapters in ``outpulse.sources.driver_tables``."""

from outpulse.catalog.registry import SHARED_SQL
from outpulse.functions.text import CTA_WORDS, URGENCY_WORDS

SHARED_SQL["c_facts"] = """
SELECT *, CAST(price * purchased AS DECIMAL(18,2)) AS earnings FROM (
SELECT 'm' || event_id AS message_id, 'acct_' || user_id AS account,
  'tpl_' || ((user_id * 20 + CAST(json_extract_string(props, '$.k') AS BIGINT) * CAST(json_extract_string(props, '$.k') AS BIGINT) // 100)
    % (SELECT count(*) FROM documents)) AS template,
  'S' || (user_id % 7) AS sender, ts AS sent_at, CAST(ts AS DATE) AS sent_date,
  CASE WHEN event_type = 'signup' AND event_id % 10 = 0 THEN 0 ELSE 10 + event_id % 90 END AS sent,
  CASE WHEN event_type = 'error' AND event_id % 8 = 0 THEN 15 + event_id % 90
       WHEN event_type = 'signup' AND event_id % 10 = 0 THEN 0
       WHEN event_type IN ('signup', 'error') THEN (10 + event_id % 90) // 5
       ELSE (10 + event_id % 90) // 2 END AS viewed,
  CASE WHEN event_type = 'purchase' THEN 1 + event_id % 5
       WHEN event_type = 'click' AND event_id % 4 = 0 THEN 1 ELSE 0 END AS purchased,
  CASE WHEN event_id % 6 = 0 THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END AS price
FROM events)"""

SHARED_SQL["c_sales"] = """
SELECT *, CASE WHEN flag = 'R' THEN 0 ELSE CAST(price * (sent // 4) AS DECIMAL(18,2)) END AS earnings FROM (
SELECT l_orderkey || '-' || l_linenumber AS message_id, 'acct_' || l_suppkey AS account,
  'tpl_' || l_partkey AS template, 'S' || (l_suppkey % 7) AS sender,
  l_shipdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)) + to_minutes(CAST(l_linenumber * 7 % 60 AS BIGINT)) AS sent_at,
  CAST(l_shipdate AS DATE) AS sent_date, CAST(l_quantity AS BIGINT) AS sent,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN CAST(l_quantity AS BIGINT) + 1
       ELSE CAST(l_quantity AS BIGINT) // 2 END AS viewed,
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) // 4 END AS purchased,
  CAST(p_retailprice / 10 AS DECIMAL(18,2)) AS price, l_returnflag AS flag
FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SHARED_SQL["c_accounts"] = """
SELECT 'acct_' || c_custkey AS account, c_name AS display_name,
  ['main', 'vip', 'free'][c_custkey % 3 + 1] AS page_type,
  'acct_' || c_custkey || '__' || ['main', 'vip', 'free'][c_custkey % 3 + 1] AS account_page,
  (c_custkey % 3) <> 2 AS is_paid,
  ['America/New_York', 'UTC', 'Europe/Paris', 'Asia/Tokyo', 'America/Denver'][n_regionkey + 1] AS tz,
  [-5, 0, 1, 9, -7][n_regionkey + 1] AS utc_offset,
  6 + c_custkey % 4 AS min_hour, 18 + c_custkey % 6 AS max_hour,
  c_acctbal >= -500 AS is_active, 'S' || (c_custkey % 7) AS assignee,
  ['grow', 'balance', 'retain'][c_custkey % 3 + 1] AS page_state,
  CASE WHEN c_acctbal >= 7000 THEN 'high' WHEN c_acctbal >= 3000 THEN 'medium' ELSE 'low' END AS tier,
  100 + c_custkey * 37 % 5000 AS active_fans,
  (c_custkey % 100)::DOUBLE / 100 AS renew_on_pct, 3 + c_custkey % 4 AS daily_quota
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

SHARED_SQL["c_templates"] = """
SELECT 'tpl_' || doc_id AS template, doc_id, text AS body, source AS category, lang,
  'acct_' || (1 + doc_id % (SELECT max(user_id) FROM events)) AS owned_by FROM documents"""


def sql_strip_html(x: str) -> str:
    a = f"regexp_replace({x}, '(?is)<(script|style)\\b.*?</(script|style)>', ' ', 'g')"
    b = f"regexp_replace({a}, '<[^>]*>', ' ', 'g')"
    c = f"regexp_replace({b}, '&[A-Za-z0-9#]+;', ' ', 'g')"
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) END)"


def tier(p: str, top: str = "premium") -> str:
    high = f"WHEN {p} < 50 THEN 'high' ELSE '{top}'" if top != "high" else "ELSE 'high'"
    return (
        f"CASE WHEN {p} = 0 THEN 'free' WHEN {p} < 5 THEN 'low' WHEN {p} < 20 THEN 'medium' {high} END"
    )


def band(s: str, top: str = "mega", at: int = 5000) -> str:
    return (
        f"CASE WHEN {s} < 100 THEN 'small' WHEN {s} < 1000 THEN 'medium' "
        f"WHEN {s} < {at} THEN 'large' ELSE '{top}' END"
    )


SHARED_SQL["c_landing"] = """
SELECT event_id, 'm' || event_id AS message_id, ts, ts + INTERVAL 1 HOUR AS ingested_at,
  CAST(ts + INTERVAL 1 HOUR AS DATE) AS ingestion_date,
  'run_' || strftime(ts, '%Y%m%d') AS run_id,
  'reports/' || c_name || '_' || strftime(ts, '%Y-%m-%d') || '.xlsx' AS source_file,
  '<b>' || c_name || '</b>: ' || p_name || '  ' || lower(p_type) || ' by ' || p_brand AS message,
  strftime(ts, '%b %-d, %Y at %-I:%M %p') AS sending_time, 'S' || (user_id % 7) AS sender,
  CASE WHEN event_id % 6 = 0 THEN 'N/A' WHEN event_id % 50 = 1 THEN '($' || format('{:,.2f}', value) || ')'
       ELSE '$' || format('{:,.2f}', value) END AS price,
  10 + event_id % 90 AS sent, (10 + event_id % 90) // 2 AS viewed,
  CASE WHEN event_type = 'purchase' THEN 1 + event_id % 5 ELSE 0 END AS purchased,
  CASE WHEN event_type = 'purchase' THEN '$' || format('{:,.2f}', value * (1 + event_id % 5) * 3) ELSE '' END AS earnings
FROM events JOIN part ON event_id * 7 % (SELECT count(*) FROM part) + (SELECT min(p_partkey) FROM part) = p_partkey JOIN customer ON user_id = c_custkey"""

_money = (
    "coalesce(CASE WHEN {0} LIKE '(%' THEN -1 ELSE 1 END * "
    "TRY_CAST(regexp_replace({0}, '[^0-9.\\-]', '', 'g') AS DECIMAL(18,2)), 0)"
)

SHARED_SQL["c_parsed"] = f"""
SELECT run_id, ingested_at, ingestion_date, message_id, source_file, sender, sent, viewed, purchased, message,
  message_id AS row_key, {sql_strip_html('message')} AS clean_message,
  trim(regexp_replace(lower(regexp_replace(regexp_replace(split_part(source_file, '/', -1), '(?i)\\.(xlsx|xls|csv|json)$', ''),
       '[_ \\-]+\\d{{4}}[_\\-]\\d{{2}}[_\\-]\\d{{2}}.*$', '')), '[^a-z0-9]+', ' ', 'g')) AS file_account,
  strptime(sending_time, '%b %d, %Y at %I:%M %p') AS sent_at,
  {_money.format('price')} AS price, {_money.format('earnings')} AS revenue
FROM c_landing"""

SHARED_SQL["c_split"] = """
SELECT *, nullif(trim(regexp_extract(clean_message, '^([^:]+):', 1)), '') AS raw_name,
  nullif(trim(regexp_extract(clean_message, ':\\s*(.*)$', 1)), '') AS body, CAST(sent_at AS DATE) AS sent_date
FROM c_parsed"""

SHARED_SQL["c_messages"] = """
SELECT * FROM c_split QUALIFY row_number() OVER (PARTITION BY clean_message, sender, sent_date
  ORDER BY sent_at DESC, message_id DESC) = 1"""

SHARED_SQL["c_names"] = "SELECT c_name AS raw_name, 'acct_' || c_custkey AS standard_name FROM customer WHERE c_custkey % 2 = 0"
SHARED_SQL["c_library"] = """
SELECT lower(body) AS body, 'lib_' || min(p_partkey) AS template FROM (
  SELECT p_partkey, p_name || ' ' || lower(p_type) || ' by ' || p_brand AS body FROM part WHERE p_partkey % 2 = 0)
GROUP BY lower(body)"""


_EDGE = "[^\\p{L}\\p{N}_]"


def word_match(words: str) -> str:
    return f"regexp_matches(lower(body), '(^|{_EDGE})({words})($|{_EDGE})')"


CONTENT_LEVEL = f"""CASE WHEN {word_match('nsfw|adult|explicit')} THEN 'explicit'
  WHEN {word_match('tease|flirt|intimate|buy|unlock|tip|bundle|sale|special|discount|exclusive|vip|premium|ppv|pay per view')} THEN 'moderate'
  WHEN {word_match('cute|sweet|hello|hi|good morning|good night|love|heart|beautiful|gorgeous|amazing|wonderful')} THEN 'mild'
  ELSE 'pending_review' END"""

_CTA, _URGENCY = ("|".join(w.replace("'", "''") for w in words) for words in (CTA_WORDS, URGENCY_WORDS))
_THEMES = {
    "birthday": "birthday|bday|cake|candle|celebration|party",
    "greeting": None,
    "motivational": "motivat|inspir|success|achieve|dream|goal|believe|strong|confident|power|positiv",
    "promotional": "sale|discount|offer|deal|promo|special|exclusive|limited|bundle|ppv",
    "question": None,
    "romantic": "love|heart|romance|valentine|kiss|cuddle|darling|sweetheart|date|romantic",
    "seasonal": "christmas|halloween|thanksgiving|easter|summer|winter|spring|fall|holiday|xmas|nye|new year",
    "urgent": "now|today|tonight|hurry|quick|limited|expires|last chance",
}
_ASK = "regexp_matches(trim(body), '\\?\\s*$')"
_GREET = f"regexp_matches(lower(body), '^(hey|hi|hello|good morning|good night|gm|gn|what''s up|how are you)($|{_EDGE})')"


def _theme(tag: str) -> str:
    if tag == "greeting":
        return _GREET
    if tag == "question":
        return _ASK
    test = word_match(_THEMES[tag])
    return f"({test} OR regexp_matches(lower(body), '[!]{{2,}}'))" if tag == "urgent" else test


_EMOJIS = (
    "len(regexp_extract_all(body, '[\\x{1F300}-\\x{1F9FF}\\x{2600}-\\x{26FF}\\x{2700}-\\x{27BF}"
    "\\x{1F000}-\\x{1F02F}\\x{1F0A0}-\\x{1F0FF}\\x{1F100}-\\x{1F1FF}]'))"
)
SHARED_SQL["c_features"] = f"""
SELECT *, CASE WHEN words < 12 THEN 'short' WHEN words <= 24 THEN 'med' ELSE 'long' END AS length_bin,
  CASE WHEN emojis = 0 THEN 'none' WHEN emojis <= 2 THEN 'low' WHEN emojis <= 5 THEN 'medium' ELSE 'high' END AS emoji_bin
FROM (SELECT template, category, lang, body, len(regexp_extract_all(body, '[\\p{{L}}\\p{{N}}]+')) AS words,
  {_EMOJIS} AS emojis, {word_match(_CTA)} AS has_cta,
  ({word_match(_URGENCY)} OR regexp_matches(lower(body), '[!]{{2,}}')) AS has_urgency, {_ASK} AS ends_with_question,
  {CONTENT_LEVEL} AS content_level,
  CASE WHEN trim(body) = '' THEN 'untagged' ELSE concat_ws(',', {', '.join(f"CASE WHEN {_theme(t)} THEN '{t}' END" for t in _THEMES)}) END AS theme_tags
  FROM c_templates)"""
