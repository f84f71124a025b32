"""Registered queries: staging, foundation and reference data."""

from __future__ import annotations

from pyspark.sql import functions as F

from outpulse.catalog.base_sql import CONTENT_LEVEL, band, ratio, tier
from outpulse.catalog.registry import SHARED_SQL, product
from outpulse.operators import upsert
from outpulse.plans import ingest
from outpulse.sources import driver_tables as src
from outpulse.sources.reports import landing_reports

AS_OF = src.EVENTS_AS_OF
SALES = src.SALES_AS_OF


def known_names(spark, d):
    return src.table(spark, d, "customer").where("c_custkey % 2 = 0").selectExpr(
        "c_name AS raw_name", "concat('acct_', c_custkey) AS standard_name"
    )


def library(spark, d):
    body = "lower(concat(p_name, ' ', p_type, ' by ', p_brand))"
    return (
        src.table(spark, d, "part").where("p_partkey % 2 = 0").selectExpr(f"{body} AS body", "p_partkey")
        .groupBy("body").agg(F.concat(F.lit("lib_"), F.min("p_partkey")).alias("template"))
    )


@product(
    "parsed_reports",
    "message_id row_key sender sent:i clean_message file_account sent_at:t price:r revenue:r",
    "SELECT * FROM c_parsed",
)
def _(spark, d):
    return ingest.parsed_reports(landing_reports(spark, d))


SHARED_SQL["c_labelled"] = """
SELECT message_id, template, account, sent_at, sent_date, sent, viewed, purchased,
  CASE WHEN sent = 0 AND (viewed > 0 OR purchased > 0) THEN 'zero_send_anomaly'
       WHEN viewed > sent THEN 'view_count_anomaly'
       WHEN purchased > viewed AND viewed > 0 THEN 'purchase_count_anomaly'
       WHEN earnings > price * sent THEN 'revenue_anomaly' ELSE 'clean' END AS quality,
  CASE WHEN earnings > price * sent THEN price * purchased ELSE earnings END AS revenue,
  least(greatest(price, 0), 1000) AS price
FROM c_sales"""


@product(
    "staged_sends",
    "message_id template account sent_at:t sent_date:d sent:i viewed:i purchased:i price:r revenue:r "
    "view_rate:r purchase_rate:r revenue_per_send:r hour:i weekday:i year_month price_tier size_band quality",
    f"""SELECT *, {ratio('viewed', 'sent')} AS view_rate, {ratio('purchased', 'sent')} AS purchase_rate,
      {ratio('revenue', 'sent')} AS revenue_per_send, hour(sent_at) AS hour, dayofweek(sent_at) + 1 AS weekday,
      strftime(sent_at, '%Y-%m') AS year_month, {tier('price')} AS price_tier, {band('sent')} AS size_band
    FROM (SELECT * FROM c_labelled
          WHERE sent_at >= TIMESTAMP '2001-12-01' - INTERVAL 2600 DAY AND sent_at < TIMESTAMP '2001-12-01'
          QUALIFY row_number() OVER (PARTITION BY message_id, template, account, sent_at
                                     ORDER BY quality, revenue DESC, sent DESC) = 1)
    WHERE quality IN ('clean', 'view_count_anomaly') AND sent > 0""",
)
def _(spark, d):
    return ingest.staged_sends(src.sales_facts(spark, d), SALES, 2600)


SHARED_SQL["c_normal"] = f"""
SELECT sha256(template || '|' || sender || '|' || strftime(sent_date, '%Y-%m-%d')) AS send_key, *,
  {ratio('viewed', 'sent')} AS view_rate, {ratio('purchased', 'sent')} AS purchase_rate,
  {ratio('purchased', 'viewed')} AS purchase_given_view, {ratio('revenue', 'sent')} AS revenue_per_send,
  {tier('price', 'high')} AS price_tier, {band('sent', 'massive', 10000)} AS size_band
FROM (SELECT *, file_account AS account, sha256(lower(clean_message)) AS template, CAST(sent_at AS DATE) AS sent_date
      FROM c_parsed)
"""
NORMAL_SHAPE = (
    "send_key template sender account sent_at:t sent_date:d price:r revenue:r sent:i viewed:i purchased:i "
    "view_rate:r purchase_rate:r purchase_given_view:r revenue_per_send:r price_tier size_band message_id"
)
DEDUP = """QUALIFY row_number() OVER (PARTITION BY template, sender, sent_date
  ORDER BY sent_at DESC, message_id DESC, ingested_at DESC) = 1"""


@product(
    "normalised_reports",
    NORMAL_SHAPE,
    f"SELECT * FROM c_normal WHERE ingestion_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' {DEDUP}",
)
def _(spark, d):
    return ingest.normalised_reports(landing_reports(spark, d), "2024-01-01", "2024-01-31")


@product(
    "report_fact_upsert",
    NORMAL_SHAPE + " run_id",
    f"""WITH old AS (SELECT *, 0 AS incoming FROM c_normal WHERE ingestion_date <= DATE '2024-01-20' {DEDUP}),
      batch AS (SELECT *, 1 AS incoming FROM c_normal WHERE ingestion_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-31' {DEDUP})
    SELECT * FROM (SELECT * FROM old UNION ALL SELECT * FROM batch)
    QUALIFY row_number() OVER (PARTITION BY send_key ORDER BY ingested_at DESC, incoming, message_id DESC) = 1""",
)
def _(spark, d):
    r = landing_reports(spark, d)
    old = ingest.normalised_reports(r, "2024-01-01", "2024-01-20")
    batch = ingest.normalised_reports(r, "2024-01-15", "2024-01-31")
    return upsert.merged(old, batch, ["send_key"], "ingested_at", "message_id")


@product(
    "transferred_sends",
    "send_key account_key template_key sent_at:t sent_date:d hour_utc:i weekday:i iso_week:i month:i sent:i viewed:i "
    "price:r revenue:r net_revenue:r view_rate:r conversion_rate:r revenue_per_send:r quality",
    f"""SELECT *, sha256(account_key || '|' || template_key || '|' || strftime(sent_at, '%Y-%m-%dT%H:%M:%SZ')) AS send_key,
      CAST(local_at AS DATE) AS sent_date, hour(sent_at) AS hour_utc, dayofweek(local_at) + 1 AS weekday,
      weekofyear(local_at) AS iso_week, month(local_at) AS month, revenue * 0.8 AS net_revenue,
      {ratio('viewed', 'sent')} AS view_rate, {ratio('purchased', 'viewed')} AS conversion_rate,
      {ratio('revenue', 'sent')} AS revenue_per_send, 'valid' AS quality
    FROM (SELECT coalesce(n.standard_name, lower(coalesce(m.raw_name, m.sender))) AS account_key,
            coalesce(l.template, md5(lower(m.body))) AS template_key,
            m.sent_at - INTERVAL 7 HOUR AS local_at, m.sent_at, m.sent, m.viewed, m.purchased, m.price, m.revenue
          FROM c_messages m LEFT JOIN c_names n ON lower(n.raw_name) = lower(coalesce(m.raw_name, m.sender))
          LEFT JOIN c_library l ON l.body = lower(m.body)
          WHERE m.sent > 0 AND m.sent_at >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY AND m.sent_at < TIMESTAMP '2024-01-31')""",
)
def _(spark, d):
    return ingest.transferred_sends(
        landing_reports(spark, d), known_names(spark, d), library(spark, d), AS_OF, 30, "America/Denver"
    )


SHARED_SQL["c_recent_messages"] = """
SELECT * FROM c_messages WHERE sent_at >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY AND sent_at < TIMESTAMP '2024-01-31'"""


@product(
    "new_templates",
    "template raw_name body uses:i last_used_at:t avg_price:r kind length_class tags",
    """SELECT md5(lower(body)) AS template, raw_name, body, uses, last_used_at, avg_price,
      CASE WHEN regexp_matches(lower(body), 'tip|ppv|pay|buy|purchase|exclusive|unlock') THEN 'ppv'
           WHEN regexp_matches(lower(body), 'sale|discount|offer|promo|deal|limited') THEN 'promo'
           WHEN regexp_matches(lower(body), 'hello|hi|hey|morning|night|welcome') THEN 'greeting'
           WHEN regexp_matches(lower(body), 'click|link|bio|check out|swipe') THEN 'cta'
           WHEN regexp_matches(lower(body), 'free|freebie|gift') THEN 'free'
           WHEN regexp_matches(lower(body), 'custom|personal|request') THEN 'custom' ELSE 'general' END AS kind,
      CASE WHEN length(body) < 50 THEN 'short' WHEN length(body) < 150 THEN 'medium'
           WHEN length(body) < 300 THEN 'long' ELSE 'very_long' END AS length_class,
      concat_ws(',', CASE WHEN regexp_matches(lower(body), 'tip|ppv|pay') THEN 'monetization' END,
        CASE WHEN regexp_matches(lower(body), 'sale|discount|offer') THEN 'promotion' END,
        CASE WHEN regexp_matches(lower(body), 'hello|hi|hey') THEN 'greeting' END,
        CASE WHEN regexp_matches(lower(body), '#\\w+') THEN 'hashtags' END,
        CASE WHEN regexp_matches(lower(body), 'http|www\\.|\\.com|link\\.bio') THEN 'links' END) AS tags
    FROM (SELECT raw_name, body, count(*) AS uses, max(sent_at) AS last_used_at, avg(price::DOUBLE) AS avg_price
          FROM c_recent_messages WHERE raw_name IS NOT NULL AND length(body) > 5 GROUP BY 1, 2)
    WHERE lower(body) NOT IN (SELECT body FROM c_library)""",
)
def _(spark, d):
    return ingest.new_templates(landing_reports(spark, d), library(spark, d), AS_OF)


@product(
    "new_name_mapping",
    "raw_name normal_name base_name standard_name account_type messages:i sent:i revenue:r last_seen:t",
    """SELECT raw_name, lower(raw_name) AS normal_name, regexp_replace(lower(raw_name), '[^a-z0-9]', '', 'g') AS base_name,
      regexp_replace(regexp_replace(lower(raw_name), '[^a-z0-9]', '_', 'g'), '_+', '_', 'g') AS standard_name,
      CASE WHEN regexp_matches(lower(raw_name), 'free|trial') THEN 'free'
           WHEN regexp_matches(lower(raw_name), 'vip|premium|paid') THEN 'paid'
           WHEN revenue > 1000 THEN 'premium' WHEN revenue > 100 THEN 'standard' ELSE 'basic' END AS account_type,
      messages, sent, revenue, last_seen
    FROM (SELECT raw_name, count(*) AS messages, sum(sent) AS sent, CAST(sum(revenue) AS DOUBLE) AS revenue, max(sent_at) AS last_seen
          FROM c_recent_messages WHERE length(raw_name) > 2 GROUP BY 1)
    WHERE lower(raw_name) NOT IN (SELECT lower(raw_name) FROM c_names)""",
)
def _(spark, d):
    return ingest.name_mapping(landing_reports(spark, d), known_names(spark, d), AS_OF)


@product(
    "template_dimension",
    "template template_id category tags:j tag_count:i body_length:i content_level owner",
    f"""SELECT t.template, 'CAP_' || t.template AS template_id, category, tags, len(tags) AS tag_count, length(body) AS body_length,
      {CONTENT_LEVEL} AS content_level, owner
    FROM (SELECT *, list_sort(list_distinct(list_filter(regexp_extract_all(lower(body), '#(\\w+)', 1), lambda x: length(x) > 2))) AS tags FROM c_templates) t
    LEFT JOIN (SELECT template, max_by(account, (sent_at, message_id)) AS owner FROM c_facts GROUP BY 1) o USING (template)""",
)
def _(spark, d):
    owners = src.send_facts(spark, d).groupBy("template").agg(
        F.max_by("account", F.struct("sent_at", "message_id")).alias("owner")
    )
    return ingest.template_dimension(src.templates(spark, d), owners)


@product(
    "account_dimension",
    "account display_name account_type primary_type segment avg_revenue:r revenue_volatility:r active_days:i account_status assignee last_active:d",
    """SELECT account, display_name,
      CASE WHEN avg_revenue >= 100 THEN 'premium' WHEN avg_revenue >= 10 THEN 'vip' ELSE 'standard' END AS account_type,
      page_type AS primary_type,
      CASE WHEN avg_revenue >= 100 THEN 'whale' WHEN avg_revenue >= 10 THEN 'high_value' WHEN avg_revenue >= 1 THEN 'regular'
           WHEN avg_revenue > 0 THEN 'casual' ELSE 'inactive' END AS segment, avg_revenue, revenue_volatility,
      coalesce(active_days, 0) AS active_days,
      CASE WHEN DATE '2024-01-31' - last_active <= 7 THEN 'active' WHEN DATE '2024-01-31' - last_active <= 30 THEN 'dormant'
           WHEN DATE '2024-01-31' - last_active <= 90 THEN 'at_risk' ELSE 'churned' END AS account_status, assignee, last_active
    FROM c_accounts LEFT JOIN (SELECT account, avg(earnings::DOUBLE) AS avg_revenue, stddev_samp(earnings::DOUBLE) AS revenue_volatility,
      count(DISTINCT sent_date) AS active_days, max(sent_date) AS last_active
      FROM c_facts WHERE sent_at >= TIMESTAMP '2024-01-31' - INTERVAL 90 DAY AND sent_at < TIMESTAMP '2024-01-31' GROUP BY 1) USING (account)""",
)
def _(spark, d):
    dim = ingest.account_dimension(src.accounts(spark, d), src.send_facts(spark, d), AS_OF)
    return dim.withColumn("primary_type", F.col("page_types.primary")).fillna(0, ["active_days"])


FACT_SHAPE = (
    "message_id template_key account_key sent_at:t hour:i weekday:i week:i month:i sent:i viewed:i purchased:i price:r "
    "earnings:r net_revenue:r view_rate:r purchase_rate:r conversion_rate:r revenue_per_send:r revenue_per_purchase:r bounce_rate:r quality"
)
SHARED_SQL["c_fact"] = f"""
SELECT f.*, coalesce(t.template, 'UNKNOWN') AS template_key, coalesce(a.account, 'UNKNOWN') AS account_key,
  hour(sent_at) AS hour, dayofweek(sent_at) + 1 AS weekday, (dayofyear(sent_at) + 6 - dayofweek(sent_at)) // 7 AS week,
  month(sent_at) AS month, earnings * 0.8 AS net_revenue, {ratio('viewed', 'sent')} AS view_rate,
  {ratio('purchased', 'sent')} AS purchase_rate, {ratio('purchased', 'viewed')} AS conversion_rate,
  {ratio('earnings * 0.8', 'sent')} AS revenue_per_send, {ratio('earnings * 0.8', 'purchased')} AS revenue_per_purchase,
  {ratio('sent - viewed', 'sent')} AS bounce_rate,
  CASE WHEN sent = 0 THEN 'zero_sends' WHEN viewed > sent THEN 'view_anomaly' WHEN purchased > viewed THEN 'purchase_anomaly'
       ELSE 'valid' END AS quality
FROM c_facts f LEFT JOIN c_accounts a USING (account) LEFT JOIN c_templates t USING (template)"""


@product("send_fact", FACT_SHAPE, "SELECT * FROM c_fact")
def _(spark, d):
    return ingest.send_fact(src.send_facts(spark, d), src.accounts(spark, d), src.templates(spark, d))


SHARED_SQL["c_dm"] = f"""
SELECT *, hour(local_at) AS hod, (dayofweek(local_at) + 6) % 7 AS dow FROM (
SELECT f.*, a.account_page, a.is_paid, sent_at + to_hours(CAST(utc_offset AS BIGINT)) AS local_at,
  CASE WHEN price > 0 THEN 'paid' ELSE 'free' END AS kind, {ratio('viewed', 'sent')} AS open_rate,
  {ratio('purchased', 'sent')} AS buy_rate, {ratio('purchased', 'viewed')} AS buy_rate_viewed,
  {ratio('earnings * 0.8', 'sent')} AS rps, {ratio('earnings', 'purchased')} AS revenue_per_buyer
FROM c_facts f JOIN c_accounts a USING (account)
WHERE sent > 0 AND viewed <= sent AND purchased <= viewed AND sent_at < TIMESTAMP '2024-01-31')"""


@product(
    "dm_send_facts",
    "message_id account_page template local_at:t dow:i hod:i kind price:r sent:i open_rate:r buy_rate:r buy_rate_viewed:r rps:r revenue_per_buyer:r",
    "SELECT * FROM c_dm WHERE sent_at >= TIMESTAMP '2024-01-31' - INTERVAL 28 DAY",
)
def _(spark, d):
    return ingest.dm_send_facts(src.send_facts(spark, d), src.accounts(spark, d), AS_OF, 28)


@product(
    "local_sends",
    "message_id account template local_at:t local_date:d dow:i hod:i price:r sent:i log_price:r rps:r",
    f"""SELECT f.*, CAST(local_at AS DATE) AS local_date, (dayofweek(local_at) + 6) % 7 AS dow, hour(local_at) AS hod,
      CASE WHEN price > 0 THEN ln(price::DOUBLE) END AS log_price, {ratio('earnings', 'sent')} AS rps
    FROM (SELECT c_facts.*, sent_at + to_hours(CAST(utc_offset AS BIGINT)) AS local_at
          FROM c_facts JOIN c_accounts USING (account) WHERE is_active AND sent_at < TIMESTAMP '2024-01-31') f""",
)
def _(spark, d):
    return ingest.local_sends(src.send_facts(spark, d), src.accounts(spark, d), AS_OF)


@product(
    "sends_by_page", "message_id account_page sent_date:d sent:i earnings:r",
    "SELECT message_id, coalesce(account_page, account || '__main') AS account_page, sent_date, sent, earnings FROM c_facts LEFT JOIN c_accounts USING (account) WHERE sent_date BETWEEN DATE '2024-01-31' - 90 AND DATE '2024-01-31'",
)
def _(spark, d):
    return ingest.sends_by_page(src.send_facts(spark, d), src.accounts(spark, d), AS_OF, 90)


@product(
    "active_accounts", "account account_page is_paid assignee tier last_active:d",
    """SELECT account, account || '__' || primary_type AS account_page, primary_type <> 'free' AS is_paid,
         CASE WHEN CAST(substr(account, 6) AS BIGINT) % 4 = 0 THEN 'lead' ELSE assignee END AS assignee, segment AS tier, last_active
       FROM o_account_dimension WHERE account_status = 'active' AND last_active >= DATE '2024-01-31' - 21""",
)
def _(spark, d):
    a = src.accounts(spark, d)
    overrides = a.where(F.substring("account", 6, 20).cast("long") % 4 == 0).select("account", F.lit("lead").alias("assignee"))
    return ingest.active_accounts(ingest.account_dimension(a, src.send_facts(spark, d), AS_OF), AS_OF, overrides)


@product(
    "account_state", "account page_state revenue_7d:r revenue_28d:r",
    """SELECT account, page_state, coalesce(r7, 0) AS revenue_7d, coalesce(r28, 0) AS revenue_28d FROM c_accounts LEFT JOIN (
         SELECT account, sum(earnings) FILTER (sent_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY) AS r7, sum(earnings) AS r28 FROM c_facts
         WHERE sent_at >= TIMESTAMP '2024-01-31' - INTERVAL 28 DAY AND sent_at < TIMESTAMP '2024-01-31' GROUP BY 1) USING (account)""",
)
def _(spark, d):
    return ingest.account_state(src.send_facts(spark, d), src.accounts(spark, d), AS_OF)


_TIERS = ("free", "low", "medium", "high", "premium")


@product(
    "price_tier_pivot", "account " + " ".join(f"{t}_sends:i {t}_revenue:r" for t in _TIERS),
    "SELECT account, "
    + ", ".join(f"count(*) FILTER (t = '{t}') AS {t}_sends, coalesce(CAST(sum(earnings) FILTER (t = '{t}') AS DOUBLE), 0) AS {t}_revenue" for t in _TIERS)
    + f" FROM (SELECT *, {tier('price')} AS t FROM c_facts) GROUP BY 1",
)
def _(spark, d):
    return ingest.kind_pivot(src.send_facts(spark, d)).fillna(0)


def _halves(spark, d):
    f = src.send_facts(spark, d).select("message_id", "account", "sent_date", "sent", "earnings")
    return f.where("sent_date <= '2024-01-20'"), f.where("sent_date >= '2024-01-15'").withColumn("sent", F.col("sent") + 1)


@product(
    "keyed_append", "message_id account sent:i",
    "SELECT message_id, account, sent + 1 AS sent FROM c_facts WHERE sent_date > DATE '2024-01-20'",
)
def _(spark, d):
    old, new = _halves(spark, d)
    return upsert.added_only(old, new, ["message_id"], [F.col("sent")])


@product(
    "batch_upsert", "message_id account sent:i",
    "SELECT message_id, account, CASE WHEN sent_date >= DATE '2024-01-15' THEN sent + 1 ELSE sent END AS sent FROM c_facts",
)
def _(spark, d):
    old, new = _halves(spark, d)
    return upsert.merged_any(old, new, ["message_id"])
