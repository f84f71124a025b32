"""Registered queries: dashboards, checks, library upkeep and mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from outpulse.catalog import advice as adv
from outpulse.catalog import ingest as ing
from outpulse.catalog import planning as pl
from outpulse.catalog import ranking as rk
from outpulse.catalog import semantic as sem
from outpulse.catalog.base_sql import ratio
from outpulse.catalog.registry import SHARED_SQL, layer, product
from outpulse.catalog.semantic import AS_OF, NOW, TODAY
from outpulse.functions import text
from outpulse.plans import content, ingest, quality, semantic, slots
from outpulse.sources import driver_tables as src
from outpulse.sources.reports import landing_reports

_DAYS30 = f"sent_date BETWEEN {TODAY} - 30 AND {TODAY}"


@product(
    "revenue_overview", "sent_date:d messages:i sent:i revenue:r avg_price:r view_rate:r purchase_rate:r order_value:r previous:r growth:r",
    f"""SELECT *, lag(revenue) OVER (ORDER BY sent_date) AS previous, (revenue - lag(revenue) OVER (ORDER BY sent_date)) / nullif(lag(revenue) OVER (ORDER BY sent_date), 0) AS growth
      FROM (SELECT sent_date, count(*) AS messages, sum(sent) AS sent, CAST(sum(earnings) AS DOUBLE) AS revenue, avg(price::DOUBLE) AS avg_price, sum(viewed) / sum(sent) AS view_rate,
        sum(purchased) / sum(sent) AS purchase_rate, {ratio('sum(earnings)', 'sum(purchased)')} AS order_value FROM c_facts GROUP BY 1)""",
)
def _(spark, d):
    return quality.revenue_overview(sem.facts(spark, d), AS_OF)


@product(
    "assignee_performance", "assignee accounts:i messages:i revenue:r conversion:r per_message:r per_account:r revenue_rank:i conversion_rank:i efficiency_rank:i score:r",
    f"""SELECT *, revenue_rank * 0.5 + conversion_rank * 0.3 + efficiency_rank * 0.2 AS score FROM (SELECT *, rank() OVER (ORDER BY revenue DESC) AS revenue_rank, rank() OVER (ORDER BY conversion DESC) AS conversion_rank,
        rank() OVER (ORDER BY per_message DESC) AS efficiency_rank FROM (SELECT assignee, count(DISTINCT account) AS accounts, count(*) AS messages, CAST(sum(earnings) AS DOUBLE) AS revenue,
        sum(purchased) / sum(sent) AS conversion, CAST(sum(earnings) AS DOUBLE) / count(*) AS per_message, CAST(sum(earnings) AS DOUBLE) / count(DISTINCT account) AS per_account
        FROM c_facts JOIN c_accounts USING (account) WHERE {_DAYS30} GROUP BY 1))""",
)
def _(spark, d):
    return quality.assignee_performance(sem.facts(spark, d), src.accounts(spark, d), AS_OF)


@product(
    "account_leaderboard", "account messages:i sent:i revenue:r purchase_rate:r per_send:r revenue_rank:i conversion_rank:i efficiency_rank:i tier",
    f"""SELECT *, CASE WHEN {TODAY} - last_active > 7 THEN 'INACTIVE' WHEN purchase_rate >= 0.05 AND per_send >= 0.1 THEN 'EXCELLENT' WHEN purchase_rate >= 0.03 AND per_send >= 0.05 THEN 'GOOD'
        WHEN purchase_rate >= 0.01 THEN 'FAIR' ELSE 'POOR' END AS tier, rank() OVER (ORDER BY revenue DESC) AS revenue_rank, rank() OVER (ORDER BY purchase_rate DESC) AS conversion_rank,
        rank() OVER (ORDER BY per_send DESC) AS efficiency_rank
      FROM (SELECT account, count(*) AS messages, sum(sent) AS sent, CAST(sum(earnings) AS DOUBLE) AS revenue, sum(purchased) / sum(sent) AS purchase_rate, CAST(sum(earnings) AS DOUBLE) / sum(sent) AS per_send,
        max(sent_date) AS last_active FROM c_facts WHERE {_DAYS30} GROUP BY 1 HAVING sum(sent) > 10)""",
)
def _(spark, d):
    return quality.account_leaderboard(sem.facts(spark, d), AS_OF)


@product(
    "prediction_accuracy", "account template predicted:r recommended:i actual:r error:r accuracy",
    """SELECT *, CASE WHEN error <= 0.01 THEN 'EXCELLENT' WHEN error <= 0.02 THEN 'GOOD' WHEN error <= 0.03 THEN 'FAIR' ELSE 'POOR' END AS accuracy FROM (SELECT *, abs(predicted - actual) AS error FROM (
       SELECT a.account, p.template, avg(p_buy) AS predicted, count(*) AS recommended FROM c_prelim p JOIN c_accounts a USING (account_page) GROUP BY 1, 2)
       JOIN (SELECT account, template, sum(purchased) / sum(sent) AS actual FROM c_facts GROUP BY 1, 2 HAVING sum(sent) > 0) USING (account, template))""",
)
def _(spark, d):
    p = pl.preliminary(spark, d).join(src.accounts(spark, d).select("account", "account_page"), "account_page")
    return quality.prediction_accuracy(p, sem.facts(spark, d))


@product(
    "executive_summary", "accounts:i active_days:i messages:i revenue:r conversion:r previous_revenue:r previous_conversion:r per_account:r per_message:r growth:r conversion_change:r",
    f"""SELECT *, revenue / accounts AS per_account, revenue / messages AS per_message, (revenue - previous_revenue) / previous_revenue AS growth, conversion - previous_conversion AS conversion_change
      FROM (SELECT count(DISTINCT account) AS accounts, count(DISTINCT sent_date) AS active_days, count(*) AS messages, CAST(sum(earnings) AS DOUBLE) AS revenue, sum(purchased) / sum(sent) AS conversion
          FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 30 DAY AND sent_at < {NOW}),
        (SELECT CAST(sum(earnings) AS DOUBLE) AS previous_revenue, sum(purchased) / sum(sent) AS previous_conversion FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 60 DAY AND sent_at < {NOW} - INTERVAL 30 DAY)""",
)
def _(spark, d):
    return quality.executive_summary(sem.facts(spark, d), AS_OF)


@product(
    "feature_overview", "computed_date:d features:i avg_rps:r avg_confidence:r eligibility:r median_score:r accounts:i",
    f"""SELECT {TODAY} AS computed_date, count(*) AS features, avg(rps_smoothed) AS avg_rps, avg(confidence) AS avg_confidence, avg(CASE WHEN eligible THEN 1 ELSE 0 END) AS eligibility,
        quantile_disc(base_score, 0.5) AS median_score, count(DISTINCT account_page) AS accounts FROM c_store""",
)
def _(spark, d):
    return quality.feature_overview(rk.store(spark, d))


@product(
    "top_templates", "account_page template category rps:r confidence:r score:r rps_rank:i confidence_rank:i overall_rank:i status",
    """SELECT *, CASE WHEN eligible THEN 'Eligible' WHEN fatigue > 0.8 THEN 'Fatigued' ELSE 'Cooling Down' END AS status FROM (SELECT *, rank() OVER (ORDER BY rps DESC) AS rps_rank, rank() OVER (ORDER BY confidence DESC) AS confidence_rank,
        rank() OVER (ORDER BY score DESC) AS overall_rank FROM (SELECT account_page, template, category, round(rps_smoothed, 9) AS rps, round(confidence, 9) AS confidence, round(base_score, 9) AS score, eligible, fatigue FROM c_store))
      ORDER BY overall_rank, account_page, template LIMIT 100""",
)
def _(spark, d):
    return quality.top_templates(rk.store(spark, d))


@product(
    "exploration_balance", "account_page total:i new:i exploring:i exploiting:i avg_ucb:r status",
    """SELECT *, CASE WHEN new > 0.3 * total THEN 'High Exploration' WHEN new > 0.1 * total THEN 'Balanced' ELSE 'Low Exploration' END AS status FROM (SELECT account_page, count(*) AS total,
        count(*) FILTER (sends_30d < 10) AS new, count(*) FILTER (sends_30d BETWEEN 10 AND 50) AS exploring, count(*) FILTER (sends_30d > 50) AS exploiting, avg(ucb) AS avg_ucb FROM c_store GROUP BY 1)""",
)
def _(spark, d):
    return quality.exploration_balance(rk.store(spark, d))


@product(
    "best_hour_patterns", "hour:i templates:i best_rps:r avg_rps:r lift_pct:r",
    f"""SELECT *, 100 * {ratio('best_rps - avg_rps', 'avg_rps')} AS lift_pct FROM (SELECT best_hour AS hour, count(*) AS templates, avg(best_hour_rps) AS best_rps, avg(rps_smoothed) AS avg_rps FROM c_store GROUP BY 1)""",
)
def _(spark, d):
    return quality.best_hour_patterns(rk.store(spark, d))


def fact(spark, d):
    return ingest.send_fact(sem.facts(spark, d), src.accounts(spark, d), src.templates(spark, d))


@product(
    "dataset_quality", "dataset records:i missing_keys:i out_of_range:i inconsistent:i score_pct:r",
    """SELECT *, 100 * (1 - (missing_keys + out_of_range) / records) AS score_pct FROM (
       SELECT 'feature_store' AS dataset, count(*) AS records, 0 AS missing_keys, count(*) FILTER (confidence > 1) AS out_of_range, count(*) FILTER (sends_30d = 0 AND rps_30d > 0) AS inconsistent FROM c_store
       UNION ALL SELECT 'send_fact', count(*), count(*) FILTER (template_key = 'UNKNOWN'), count(*) FILTER (purchased > sent), count(*) FILTER (quality <> 'valid') FROM c_fact)""",
)
def _(spark, d):
    return quality.dataset_quality(rk.store(spark, d), fact(spark, d))


@product(
    "refresh_gate", "features:i confidence:r eligible_rate:r eligible:i age_hours:i day_sends:i health:i gate alerts:j",
    f"""SELECT *, CASE WHEN age_hours < 26 THEN 25 ELSE 0 END + CASE WHEN eligible_rate > 0.3 THEN 25 ELSE 15 END + CASE WHEN day_sends > 100 THEN 25 ELSE 15 END + CASE WHEN confidence > 0.05 THEN 25 ELSE 15 END AS health,
        CASE WHEN features > 100 AND confidence > 0.05 AND eligible > 50 THEN 'PASSED' ELSE 'FAILED' END AS gate,
        {adv._present(('age_hours > 26', 'stale'), ('confidence < 0.05', 'low_confidence'), ('eligible_rate < 0.1', 'low_eligibility'), ('day_sends < 10', 'low_volume'))} AS alerts
      FROM (SELECT count(*) AS features, avg(confidence) AS confidence, avg(CASE WHEN eligible THEN 1 ELSE 0 END) AS eligible_rate, count(*) FILTER (eligible) AS eligible,
        (epoch_us({NOW}) - epoch_us(max(last_sent_at))) // 3600000000 AS age_hours, (SELECT count(*) FROM c_fact WHERE sent_date = {TODAY} - 1) AS day_sends FROM c_store)""",
)
def _(spark, d):
    return quality.refresh_gate(rk.store(spark, d), fact(spark, d), AS_OF)


@product(
    "data_quality_check", "rows_last_day:i avg_daily:r sd_daily:r staleness_minutes:i volume_z:r unknown_rate:r views_rate:r buys_rate:r invalid_rate:r volume_status overall",
    f"""SELECT *, CASE WHEN volume_z > 3 THEN 'ANOMALY' WHEN volume_z > 2 THEN 'WARNING' ELSE 'NORMAL' END AS volume_status, CASE WHEN staleness_minutes > 120 THEN 'CRITICAL' WHEN volume_z > 3 THEN 'WARNING_VOLUME'
        WHEN invalid_rate > 0.1 THEN 'WARNING_QUALITY' ELSE 'HEALTHY' END AS overall
      FROM (SELECT *, abs(rows_last_day - avg_daily) / nullif(sd_daily, 0) AS volume_z FROM (SELECT sum(n) FILTER (sent_date = {TODAY} - 1) AS rows_last_day, avg(n) FILTER (sent_date < {TODAY} - 1) AS avg_daily,
        stddev_samp(n) FILTER (sent_date < {TODAY} - 1) AS sd_daily, (epoch_us({NOW}) - epoch_us(max(latest))) // 60000000 AS staleness_minutes
        FROM (SELECT sent_date, count(*) AS n, max(sent_at) AS latest FROM c_fact WHERE {_DAYS30} GROUP BY 1)),
      (SELECT count(*) FILTER (template_key = 'UNKNOWN') / count(*) AS unknown_rate, count(*) FILTER (viewed > sent) / count(*) AS views_rate, count(*) FILTER (purchased > viewed) / count(*) AS buys_rate,
        count(*) FILTER (quality <> 'valid') / count(*) AS invalid_rate FROM c_fact WHERE sent_date = {TODAY} - 1))""",
)
def _(spark, d):
    return quality.data_quality_check(fact(spark, d), AS_OF)


@product(
    "landing_quality", "ingestion_date:d rows:i unique_keys:i duplicates:i no_id:i no_time:i future:i sent:i revenue:r score:r",
    """SELECT *, rows - unique_keys AS duplicates, round(100 * (1 - (no_id + no_time) / rows)) AS score FROM (SELECT ingestion_date, count(*) AS rows, count(DISTINCT (template, sender, sent_date)) AS unique_keys,
        count(*) FILTER (message_id IS NULL) AS no_id, count(*) FILTER (sent_at IS NULL) AS no_time, count(*) FILTER (sent_date > ingestion_date) AS future, sum(sent) AS sent, CAST(sum(revenue) AS DOUBLE) AS revenue
        FROM c_normal GROUP BY 1)""",
)
def _(spark, d):
    return quality.landing_quality(landing_reports(spark, d))


SHARED_SQL["c_canonical"] = "SELECT * FROM o_schedule_export WHERE ladder_position = 3"
SHARED_SQL["c_diversity"] = """
SELECT *, CASE WHEN ratio < 0.85 OR max_repeats > 5 THEN 'FAIL' WHEN ratio < 0.9 THEN 'WARN' ELSE 'PASS' END AS status FROM (SELECT account, date_local, count(*) AS templates, sum(n) AS slots, max(n) AS max_repeats, count(*) / sum(n) AS ratio
FROM (SELECT account, date_local, template, count(*) AS n FROM c_canonical GROUP BY 1, 2, 3) GROUP BY 1, 2)"""
SHARED_SQL["c_violations"] = """
WITH g AS (SELECT *, hour_no - lag(hour_no) OVER (PARTITION BY account, template ORDER BY date_local, hod, slot_rank) AS gap FROM (SELECT *, (date_local - DATE '2000-01-01') * 24 + hod AS hour_no FROM c_canonical WHERE template NOT LIKE 'FALLBACK%')),
s AS (SELECT account, string_agg(template || ' (' || gap || 'h)', ', ' ORDER BY rk) AS sample FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY gap, template, hour_no) AS rk FROM g WHERE gap < 168 QUALIFY rk <= 5) GROUP BY 1)
SELECT *, CASE WHEN violations = 0 THEN 'PASS' WHEN rate > 0.01 THEN 'FAIL' ELSE 'WARN' END AS status FROM (SELECT account, count(*) AS repeats, count(*) FILTER (gap < 168) AS violations, count(*) FILTER (gap < 168) / count(*) AS rate
  FROM g WHERE gap IS NOT NULL GROUP BY 1) LEFT JOIN s USING (account)"""
SHARED_SQL["c_distribution"] = """
SELECT *, CASE WHEN outside > 0 THEN 'FAIL' WHEN sd < 5 THEN 'WARN_LOW_VARIATION' WHEN zeros > n * 0.1 THEN 'WARN_ZEROS' ELSE 'PASS' END AS status FROM (SELECT account, count(*) AS n, min(score) AS lowest, max(score) AS highest,
  avg(score) AS mean, stddev_samp(score) AS sd, quantile_disc(score, 0.5) AS median, count(*) FILTER (score = 0) AS zeros, count(*) FILTER (score < 0 OR score > 100) AS outside FROM c_canonical GROUP BY 1)"""
SHARED_SQL["c_complete"] = """
SELECT *, CASE WHEN fill_rate < 0.999 THEN 'FAIL' WHEN fallback_rate > 0.03 THEN 'WARN' ELSE 'PASS' END AS status FROM (SELECT date_local, count(DISTINCT account) AS accounts, count(*) AS rows, count(template) AS filled,
  count(*) FILTER (template LIKE 'FALLBACK%') AS fallbacks, count(template) / count(*) AS fill_rate, count(*) FILTER (template LIKE 'FALLBACK%') / count(*) AS fallback_rate FROM c_canonical GROUP BY 1)"""


@layer("canonical_slots")
def canonical(spark, d):
    """What the checks read of the export: one narrow row per slot."""
    one = pl.export(spark, d).where(F.col("ladder_position") == 3)
    return one.select("account", "date_local", "hod", "slot_rank", "template", "score")


@product("plan_diversity", "account date_local:d templates:i slots:i max_repeats:i ratio:r status", "SELECT * FROM c_diversity")
def _(spark, d):
    return quality.plan_diversity(canonical(spark, d))


@product("cooldown_violations", "account repeats:i violations:i rate:r sample status", "SELECT * FROM c_violations")
def _(spark, d):
    return quality.cooldown_violations(canonical(spark, d))


@product("score_distribution", "account n:i lowest:r highest:r mean:r sd:r median:r zeros:i outside:i status", "SELECT * FROM c_distribution")
def _(spark, d):
    return quality.score_distribution(canonical(spark, d))


@product("plan_completeness", "date_local:d accounts:i rows:i filled:i fallbacks:i fill_rate:r fallback_rate:r status", "SELECT * FROM c_complete")
def _(spark, d):
    return quality.plan_completeness(canonical(spark, d))


def _metric(name: str, table: str, value: str) -> str:
    low, _ = quality.THRESHOLDS[name]
    return (
        f"SELECT '{name}' AS metric, {value} AS value, CASE WHEN {value} < {low} THEN 'FAIL_LOW' WHEN min(CASE WHEN status LIKE 'FAIL%' THEN 0 ELSE 1 END) = 0 THEN 'FAIL_SOME' ELSE 'PASS' END AS status FROM {table}"
    )


@product(
    "plan_health", "metric value:r status",
    " UNION ALL ".join([_metric("diversity", "c_diversity", "avg(ratio)"), _metric("cooldown_compliance", "c_violations", "1 - avg(rate)"),
                        _metric("score_quality", "c_distribution", "avg(CASE WHEN status = 'PASS' THEN 1.0 ELSE 0.0 END)"), _metric("completeness", "c_complete", "avg(fill_rate)")]),
)
def _(spark, d):
    return quality.plan_health(canonical(spark, d))


@product(
    "reconciliation", "system templates:i accounts:i sends:i revenue:r",
    """SELECT 'source' AS system, count(DISTINCT template) AS templates, count(DISTINCT account) AS accounts, count(*) AS sends, CAST(sum(earnings) AS DOUBLE) AS revenue FROM c_facts
       UNION ALL SELECT 'fact', count(DISTINCT template_key), count(DISTINCT account_key), count(*), CAST(sum(earnings) AS DOUBLE) FROM c_fact
       UNION ALL SELECT 'valid', count(DISTINCT template_key), count(DISTINCT account_key), count(*), CAST(sum(earnings) AS DOUBLE) FROM c_fact WHERE quality = 'valid'""",
)
def _(spark, d):
    return quality.reconciliation(sem.facts(spark, d), fact(spark, d))


@product(
    "bank_quality", "category templates:i avg_length:r avg_emojis:r with_cta:i with_urgency:i questions:i very_long:i length_bins levels",
    """SELECT category, count(*) AS templates, avg(length(body)) AS avg_length, avg(emojis) AS avg_emojis, count(*) FILTER (has_cta) AS with_cta, count(*) FILTER (has_urgency) AS with_urgency,
        count(*) FILTER (ends_with_question) AS questions, count(*) FILTER (length(body) > 500) AS very_long, string_agg(DISTINCT length_bin, ',' ORDER BY length_bin) AS length_bins,
        string_agg(DISTINCT content_level, ',' ORDER BY content_level) AS levels FROM c_features GROUP BY 1""",
)
def _(spark, d):
    return quality.bank_quality(src.spread(src.templates(spark, d), "template"))


@product(
    "onboarding_gaps", "name last_seen:t",
    f"""SELECT file_account AS name, max(sent_at) AS last_seen FROM c_parsed WHERE sent_at >= {NOW} - INTERVAL 2 DAY AND sent_at < {NOW}
        AND file_account NOT IN (SELECT trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) FROM customer WHERE c_custkey % 3 <> 0) GROUP BY 1
        HAVING (epoch_us({NOW}) - epoch_us(max(sent_at))) // 60000000 > 120""",
)
def _(spark, d):
    known = src.table(spark, d, "customer").where("c_custkey % 3 <> 0").select(text.normal_name("c_name").alias("name"))
    return quality.onboarding_gaps(landing_reports(spark, d), known, AS_OF)


@product("freshness", "latest:t minutes:i needs_refresh",
         f"SELECT max(sent_at) AS latest, (epoch_us({NOW}) - epoch_us(max(sent_at))) // 60000000 AS minutes, (epoch_us({NOW}) - epoch_us(max(sent_at))) // 60000000 > 1440 AS needs_refresh FROM c_facts")
def _(spark, d):
    return quality.freshness(sem.facts(spark, d), AS_OF)


@product(
    "backtest", "old_rps:r new_rps:r pairs:i improvement_pct:r",
    """SELECT *, 100 * (new_rps - old_rps) / old_rps AS improvement_pct FROM (SELECT avg(rps) AS old_rps, avg(rps) FILTER (p.account IS NOT NULL) AS new_rps, count(p.account) AS pairs
       FROM (SELECT account, template, CAST(sum(earnings) AS DOUBLE) / sum(sent) AS rps FROM c_facts WHERE sent > 0 GROUP BY 1, 2) a
       LEFT JOIN (SELECT DISTINCT account, template FROM c_weighted WHERE rank = 1) p ON p.account = a.account AND p.template = a.template)""",
)
def _(spark, d):
    return quality.backtest(pl.weighted(spark, d).where("rank = 1"), sem.facts(spark, d))


@product(
    "template_banks", "category template rps:r sent:i rank:i",
    """SELECT category, template, rps, sent, row_number() OVER (PARTITION BY category ORDER BY rps DESC, template) AS rank FROM (SELECT template, round(avg(rps), 9) AS rps, sum(total_sent) AS sent FROM c_perf GROUP BY 1)
       JOIN c_templates USING (template) QUALIFY rank <= 100""",
)
def _(spark, d):
    return quality.template_banks(rk.performance(spark, d), src.templates(spark, d))


@product(
    "week_plan_scored", "account date_local:d slot_rank:i hod:i price:r slot_score:r notice",
    """SELECT p.account, p.date_local, p.slot_rank, p.hod, p.price, slot_score, CASE WHEN f.account IS NOT NULL THEN 'window too narrow' END AS notice FROM c_plan p
       LEFT JOIN c_scorecard s ON s.account_page = p.account_page AND s.dow = p.dow AND s.hod = p.hod LEFT JOIN o_feasibility_alerts f ON f.account = p.account AND f.date_local = p.date_local""",
)
def _(spark, d):
    policy = slots.quota_policy(src.accounts(spark, d)).withColumn("quota", F.col("quota") + 3)
    plan = pl.plan(spark, d)
    return quality.week_plan_scored(plan, semantic.slot_scorecard(sem.dm(spark, d)), slots.feasibility_alerts(plan, policy))


# --- library upkeep, mappings, settings ---------------------------------------------------------


@product(
    "backfill", "account messages:i revenue:r first_at:t last_at:t",
    """SELECT account, count(*) AS messages, CAST(sum(revenue) AS DOUBLE) AS revenue, min(sent_at) AS first_at, max(sent_at) AS last_at
       FROM (SELECT coalesce(standard_name, lower(s.raw_name)) AS account, s.revenue, sent_at FROM c_split s LEFT JOIN c_names n ON lower(n.raw_name) = lower(s.raw_name) WHERE revenue >= 0)
       WHERE account IN (SELECT account FROM c_accounts WHERE is_active) GROUP BY 1""",
)
def _(spark, d):
    rows = content.backfill(landing_reports(spark, d), ing.known_names(spark, d), src.accounts(spark, d).where("is_active"))
    return content.backfill_summary(rows)


def _damaged(spark, d):
    return landing_reports(spark, d).withColumn(
        "sending_time", F.when(F.pmod(F.substring("message_id", 2, 20).cast("long"), F.lit(11)) == 0, F.lit("soon")).otherwise(F.col("sending_time")))


@product(
    "quarantined_reports", "message_id reason details",
    "SELECT message_id, 'implausible_year_or_unparsable' AS reason, 'cannot use time: soon' AS details FROM c_landing WHERE event_id % 11 = 0",
)
def _(spark, d):
    return content.quarantine(_damaged(spark, d), 2018, 2024)[1]


_MD5 = "md5(lower(trim(body)))"
_HASH2 = "sha256(regexp_replace(nfc_normalize(lower(trim(body))), '\\s+', ' ', 'g'))"
SHARED_SQL["c_inflow"] = f"""
SELECT s.*, length_bin, emoji_bin, has_cta, has_urgency, ends_with_question, content_level, theme_tags FROM (
  SELECT doc_id AS source_id, body, doc_id % 2 + 1 AS priority, {_MD5} AS hash_v1, {_HASH2} AS hash_v2 FROM c_templates
  WHERE length(trim(body)) >= 3 AND NOT contains(body, '�')
  QUALIFY row_number() OVER (PARTITION BY {_HASH2} ORDER BY doc_id % 2 + 1, doc_id) = 1) s JOIN c_features f ON f.template = 'tpl_' || source_id
WHERE hash_v1 NOT IN (SELECT {_MD5} FROM c_templates WHERE doc_id % 5 = 0) AND hash_v2 NOT IN (SELECT {_HASH2} FROM c_templates WHERE doc_id % 5 = 0)"""


def inflow(spark, d):
    docs = src.spread(src.templates(spark, d), "template")
    bank = docs.where("doc_id % 5 = 0").select(F.md5(F.lower(F.trim("body"))).alias("hash_v1"), text.canonical_hash("body").alias("hash_v2"))
    return content.template_inflow(docs.selectExpr("doc_id AS source_id", "body", "doc_id % 2 + 1 AS priority"), bank)


@product("template_inflow", "source_id:i priority:i hash_v1 hash_v2 length_bin emoji_bin has_cta has_urgency ends_with_question", "SELECT * FROM c_inflow")
def _(spark, d):
    return inflow(spark, d)


@product(
    "refused_templates", "source_id:i priority:i reason",
    """SELECT doc_id AS source_id, doc_id % 2 + 1 AS priority, CASE WHEN body IS NULL THEN 'no text' WHEN length(trim(body)) < 20 THEN 'too short'
         WHEN length(trim(body)) > 2000 THEN 'too long' ELSE 'damaged text' END AS reason FROM c_templates
       WHERE body IS NULL OR length(trim(body)) NOT BETWEEN 20 AND 2000 OR contains(body, '�')""",
)
def _(spark, d):
    docs = src.templates(spark, d).selectExpr("doc_id AS source_id", "body", "doc_id % 2 + 1 AS priority")
    return content.refused_templates(docs, 20, 2000)


@product(
    "bank_additions", "template_id hash_v2 kind content_level theme_tags length_class times_used:i",
    "SELECT 'CAP_' || substr(hash_v2, 1, 16) AS template_id, hash_v2, 'main' AS kind, content_level, theme_tags, length_bin AS length_class, 0 AS times_used FROM c_inflow",
)
def _(spark, d):
    return content.bank_rows(inflow(spark, d))


_RULE_SQL = ", ".join(
    "CASE WHEN regexp_matches(lower(body), '" + r.pattern + "')" + (f" AND NOT regexp_matches(lower(body), '{content.ALLOW_PATTERN}')" if r.family else "") + f" THEN '{r.rule_id}' END"
    for r in content.DEFAULT_RULES
)
SHARED_SQL["c_audit"] = f"""
SELECT doc_id, price, list_filter([{_RULE_SQL}], lambda x: x IS NOT NULL) AS hits,
  CASE WHEN price > 0 THEN 'paid_message' WHEN regexp_matches(lower(body), 'https://.*renew') OR (contains(lower(body), 'https://') AND regexp_matches(lower(body), 'renew(al)?')) THEN 'renewal'
       WHEN contains(lower(body), 'https://') THEN 'link_drop' WHEN regexp_matches(lower(body), 'tip (me|for|to|if|\\$)|send (a )?tip|\\$\\d+ tip') THEN 'tip_request' ELSE 'bump' END AS category,
  regexp_matches(lower(body), 'renew(al)?') AS mentions_renewal, contains(lower(body), 'https://') AS has_link
FROM (SELECT doc_id, body, CASE WHEN doc_id % 3 = 0 THEN 9.99 ELSE 0 END AS price FROM c_templates QUALIFY row_number() OVER (PARTITION BY sha256(trim(body)) ORDER BY doc_id) = 1)"""


def audit(spark, d):
    docs = src.spread(src.templates(spark, d), "template").withColumn("price", F.when(F.col("doc_id") % 3 == 0, 9.99).otherwise(0.0))
    return content.content_audit(docs)


@product("content_audit", "doc_id:i price:r hits:j category mentions_renewal has_link", "SELECT * FROM c_audit")
def _(spark, d):
    return audit(spark, d)


@product(
    "content_counts", "category rows:i violations:i percent:r",
    "SELECT category, count(*) AS rows, count(*) FILTER (len(hits) > 0) AS violations, 100 * count(*) / (SELECT count(*) FROM c_audit) AS percent FROM c_audit GROUP BY 1",
)
def _(spark, d):
    return content.audit_counts(audit(spark, d))


@product(
    "duplicate_templates", "doc_id:i copies:i",
    "SELECT doc_id, count(*) OVER (PARTITION BY sha256(trim(body))) AS copies FROM c_templates QUALIFY copies > 1",
)
def _(spark, d):
    return content.duplicate_rows(src.templates(spark, d), F.sha2(F.trim("body"), 256))


@product(
    "repaired_placeholders", "doc_id:i changed n_fixed:i",
    """SELECT doc_id, contains(body, '(ENTERNAME)') AS changed, length(replace(body, '(ENTERNAME)', 'ENTERNAME')) AS n_fixed
       FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'Renew now (ENTERNAME)! ' || body ELSE body END AS body FROM c_templates)""",
)
def _(spark, d):
    docs = src.templates(spark, d).withColumn("body", F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("Renew now (ENTERNAME)! "), "body")).otherwise(F.col("body")))
    return content.repaired_placeholders(docs, "ENTERNAME").withColumn("n_fixed", F.length("fixed"))


# Part names misspelt by dropping or doubling a letter, to be matched to the clean ones.
SHARED_SQL["c_seen_names"] = """
SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN p_name || ' VIP' WHEN 1 THEN substr(p_name, 1, 3) || substr(p_name, 5) ELSE substr(p_name, 1, 4) || substr(p_name, 4) || ' - Paid' END AS raw_name FROM part"""
_STRIP = "trim(regexp_replace(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), '(\\s+(paid|free|vip|main))+$', ''))"


def seen_names(spark, d):
    return src.table(spark, d, "part").selectExpr(
        """CASE p_partkey % 3 WHEN 0 THEN concat(p_name, ' VIP') WHEN 1 THEN concat(substr(p_name, 1, 3), substr(p_name, 5))
           ELSE concat(substr(p_name, 1, 4), substr(p_name, 4), ' - Paid') END AS raw_name""").distinct()


SHARED_SQL["c_mapped_names"] = f"""
WITH direct AS (SELECT DISTINCT p_name || ' VIP' AS raw_name, upper(p_name) AS standard_name FROM part WHERE p_name LIKE '%a%'),
rest AS (SELECT raw_name, {_STRIP.format('raw_name')} AS n FROM c_seen_names WHERE raw_name NOT IN (SELECT raw_name FROM direct)),
known AS (SELECT DISTINCT {_STRIP.format('p_name')} AS k FROM part),
best AS (SELECT raw_name, k, 1 - levenshtein(n, k)::DOUBLE / greatest(length(n), length(k)) AS score FROM rest, known
  WHERE 1 - levenshtein(n, k)::DOUBLE / greatest(length(n), length(k)) >= 0.8 QUALIFY row_number() OVER (PARTITION BY raw_name ORDER BY score DESC, k) = 1)
SELECT s.raw_name, standard_name, 'direct' AS method, 1.0::DOUBLE AS confidence FROM c_seen_names s JOIN direct USING (raw_name)
UNION ALL SELECT r.raw_name, k, CASE WHEN k IS NULL THEN 'unmapped' ELSE 'fuzzy' END, coalesce(score, 0) FROM rest r LEFT JOIN best b ON b.raw_name = r.raw_name"""


def mapped(spark, d):
    part = src.table(spark, d, "part")
    mapping = part.where(F.col("p_name").like("%a%")).select(F.concat("p_name", F.lit(" VIP")).alias("raw_name"), F.upper("p_name").alias("standard_name")).distinct()
    return content.mapped_names(seen_names(spark, d), mapping, part.select(F.col("p_name").alias("name")))


@product("mapped_names", "raw_name standard_name method confidence:r", "SELECT * FROM c_mapped_names")
def _(spark, d):
    return mapped(spark, d)


@product("mapping_coverage", "method names:i avg_confidence:r", "SELECT method, count(*) AS names, avg(confidence) AS avg_confidence FROM c_mapped_names GROUP BY 1")
def _(spark, d):
    return content.mapping_coverage(mapped(spark, d))


@product(
    "names_by_first_word", "raw_name account method",
    f"""WITH m AS (SELECT {_STRIP.format('p_name')} AS key, 'part_' || min(p_partkey) AS standard_name FROM part WHERE p_partkey % 2 = 0 GROUP BY p_name),
      e AS (SELECT key, min(standard_name) AS ex FROM m GROUP BY 1), f AS (SELECT split_part(key, ' ', 1) AS first, min(standard_name) AS bf FROM m GROUP BY 1 HAVING count(DISTINCT standard_name) = 1)
      SELECT raw_name, coalesce(ex, bf, s.key) AS account, CASE WHEN ex IS NOT NULL THEN 'exact' WHEN bf IS NOT NULL THEN 'first_name' ELSE 'fallback' END AS method
      FROM (SELECT raw_name, {_STRIP.format('raw_name')} AS key FROM c_seen_names) s LEFT JOIN e ON e.key = s.key LEFT JOIN f ON f.first = split_part(s.key, ' ', 1)""",
)
def _(spark, d):
    m = src.table(spark, d, "part").where("p_partkey % 2 = 0").groupBy("p_name").agg(F.concat(F.lit("part_"), F.min("p_partkey")).alias("standard_name"))
    return content.mapped_by_first_name(seen_names(spark, d), m.withColumnRenamed("p_name", "raw_name"))


@product(
    "cleaned_overrides", "stage rows:i accounts:i",
    "SELECT 'before' AS stage, count(*) AS rows, count(DISTINCT o_custkey) AS accounts FROM orders UNION ALL SELECT 'after', count(DISTINCT o_custkey), count(DISTINCT o_custkey) FROM orders",
)
def _(spark, d):
    o = src.table(spark, d, "orders").selectExpr("concat('acct_', o_custkey) AS account", "o_orderdate AS updated_at", "concat('o', o_orderkey) AS note")
    return content.cleaned_overrides(o)[1]


SHARED_SQL["c_feedback"] = """
WITH o AS (SELECT message_id AS override_id, account, sender AS assignee, template AS new_template, 'tpl_' || ((CAST(substr(template, 5) AS BIGINT) + 1) % (SELECT count(*) FROM documents)) AS old_template, sent_date AS day FROM c_facts),
a AS (SELECT account, template, sent_date, CAST(sum(earnings) AS DOUBLE) AS revenue FROM c_facts GROUP BY 1, 2, 3),
p AS (SELECT account, template, avg(earnings::DOUBLE) AS projected FROM c_facts GROUP BY 1, 2)
SELECT o.override_id, o.assignee, o.account, revenue, projected, revenue - projected AS delta, CASE WHEN revenue > projected * 1.1 THEN 'SUCCESS' WHEN revenue < projected * 0.9 THEN 'FAILURE' ELSE 'NEUTRAL' END AS result
FROM o JOIN a ON a.account = o.account AND a.template = o.new_template AND a.sent_date = o.day JOIN p ON p.account = o.account AND p.template = o.old_template"""


def overrides(spark, d):
    return sem.facts(spark, d).select(
        F.col("message_id").alias("override_id"), "account", F.col("sender").alias("assignee"), F.col("template").alias("new_template"),
        F.concat(F.lit("tpl_"), ((F.substring("template", 5, 18).cast("long") + 1) % src.table(spark, d, "documents").agg(F.count(F.lit(1))).scalar()).cast("string")).alias("old_template"), F.col("sent_date").alias("day"))


def feedback(spark, d):
    f = sem.facts(spark, d)
    p = f.groupBy("account", "template").agg(F.avg(F.col("earnings").cast("double")).alias("projected"))
    return content.override_feedback(overrides(spark, d), f, p)


@product("override_feedback", "override_id assignee account revenue:r projected:r delta:r result", "SELECT * FROM c_feedback")
def _(spark, d):
    return feedback(spark, d)


@product(
    "override_accuracy", "assignee overrides:i successes:i failures:i avg_delta:r total_delta:r high_value:i high_cost:i accuracy:r",
    """SELECT assignee, count(*) AS overrides, count(*) FILTER (result = 'SUCCESS') AS successes, count(*) FILTER (result = 'FAILURE') AS failures, avg(delta) AS avg_delta, sum(delta) AS total_delta,
        count(*) FILTER (delta > 10) AS high_value, count(*) FILTER (delta < -10) AS high_cost, count(*) FILTER (result = 'SUCCESS') / count(*) AS accuracy FROM c_feedback GROUP BY 1""",
)
def _(spark, d):
    return content.override_accuracy(feedback(spark, d))


SHARED_SQL["c_overrides"] = """SELECT message_id AS override_id, account, sender AS assignee, template AS new_template,
  'tpl_' || ((CAST(substr(template, 5) AS BIGINT) + 1) % (SELECT count(*) FROM documents)) AS old_template, sent_date AS day FROM c_facts"""


@product(
    "override_training", "override_id assignee account day:d result delta:r open_rate_delta:r total_overrides:i successful:i assignee_accuracy:r training_priority",
    f"""WITH a AS (SELECT account, template, sent_date, sum(viewed) / sum(sent) AS rate FROM c_facts GROUP BY 1, 2, 3), b AS (SELECT account, template, sum(viewed) / sum(sent) AS rate FROM c_facts GROUP BY 1, 2),
      j AS (SELECT o.*, result, delta, a.rate - b.rate AS open_rate_delta FROM c_overrides o LEFT JOIN c_feedback USING (override_id)
        LEFT JOIN a ON a.account = o.account AND a.template = o.new_template AND a.sent_date = o.day LEFT JOIN b ON b.account = o.account AND b.template = o.old_template)
      SELECT * FROM (SELECT *, count(*) OVER w AS total_overrides, count(*) FILTER (result = 'SUCCESS') OVER w AS successful, count(*) FILTER (result = 'SUCCESS') OVER w / count(*) OVER w AS assignee_accuracy,
        CASE WHEN delta > 10 THEN 'HIGH_VALUE_LEARNING' WHEN delta < -10 THEN 'HIGH_COST_MISTAKE' ELSE 'STANDARD_SIGNAL' END AS training_priority FROM j WINDOW w AS (PARTITION BY assignee))
      WHERE day BETWEEN {TODAY} - 30 AND {TODAY}""",
)
def _(spark, d):
    o = overrides(spark, d)
    return content.override_training(o, feedback(spark, d), content.open_rate_changes(o, sem.facts(spark, d)), AS_OF)


@product(
    "override_impacts", "assignee overrides:i successes:i failures:i avg_impact:r total_impact:r success_pct:r top_impacts:j",
    """SELECT assignee, count(*) AS overrides, count(*) FILTER (result = 'SUCCESS') AS successes, count(*) FILTER (result = 'FAILURE') AS failures, avg(delta) AS avg_impact, sum(delta) AS total_impact,
        100 * count(*) FILTER (result = 'SUCCESS') / count(*) AS success_pct, list(account || ' ' || result ORDER BY n) FILTER (n <= 5) AS top_impacts
      FROM (SELECT *, row_number() OVER (PARTITION BY assignee ORDER BY round(abs(delta), 6) DESC, override_id) AS n FROM c_feedback) GROUP BY 1""",
)
def _(spark, d):
    found = content.override_impacts(feedback(spark, d))
    return found.withColumn("top_impacts", F.transform("impacts", lambda x: F.concat_ws(" ", x["account"], x["result"])))


@product(
    "new_account_rows", "account_key account account_type status created_date:d last_active_date:d valid_from:t valid_to:t is_current source",
    f"""SELECT standard_name AS account_key, standard_name AS account, account_type, 'active' AS status, {TODAY} AS created_date, CAST(last_seen AS DATE) AS last_active_date, {NOW} AS valid_from,
        TIMESTAMP '9999-12-31 23:59:59' AS valid_to, true AS is_current, 'reports' AS source
      FROM (SELECT *, row_number() OVER (PARTITION BY standard_name ORDER BY last_seen DESC, raw_name) AS n FROM o_new_name_mapping) WHERE n = 1
        AND standard_name NOT IN (SELECT regexp_replace(lower(display_name), '[^a-z0-9]+', '_', 'g') FROM c_accounts WHERE page_state = 'grow')""",
)
def _(spark, d):
    grown = src.accounts(spark, d).where("page_state = 'grow'").select(F.regexp_replace(F.lower("display_name"), "[^a-z0-9]+", "_").alias("account_key"))
    return ingest.new_account_rows(ingest.name_mapping(landing_reports(spark, d), ing.known_names(spark, d), AS_OF), grown, AS_OF, "reports")


_HEALTH = """SELECT '{0}' AS dataset, count(*) AS records, count(*) FILTER ({1} IS NULL) AS missing_keys, count({1}) - count(DISTINCT {1}) AS repeated_keys, CAST(max({2}) AS DATE) AS latest FROM {3}"""


@product(
    "table_health", "dataset records:i missing_keys:i repeated_keys:i latest:d status",
    f"""WITH h AS (SELECT *, CASE WHEN records = 0 THEN 'EMPTY' WHEN missing_keys + repeated_keys > 0 THEN 'KEY ISSUES' WHEN {TODAY} - latest > 2 THEN 'STALE' ELSE 'HEALTHY' END AS status FROM (
        {_HEALTH.format('accounts', 'account', 'NULL::DATE', 'c_accounts')} UNION ALL {_HEALTH.format('templates', 'template', 'NULL::DATE', 'c_templates')}
        UNION ALL {_HEALTH.format('sends', 'message_id', 'sent_date', 'c_facts')}
        UNION ALL {_HEALTH.format('reports', 'CASE WHEN event_id % 13 <> 0 THEN message_id END', 'ingestion_date', 'c_landing')}
        UNION ALL {_HEALTH.format('features', "account_page || '/' || template", TODAY, 'c_store')}))
      SELECT * FROM h UNION ALL SELECT 'all', sum(records), sum(missing_keys), sum(repeated_keys), max(latest),
        CASE WHEN count(*) FILTER (status = 'EMPTY' OR missing_keys > 0) = 0 THEN 'HEALTHY' ELSE 'ISSUES DETECTED' END FROM h""",
)
def _(spark, d):
    landed = landing_reports(spark, d).withColumn("message_id", F.when(F.substring("message_id", 2, 20).cast("long") % 13 != 0, F.col("message_id")))
    return quality.with_overall([
        quality.table_health("accounts", src.accounts(spark, d), ["account"], None, AS_OF), quality.table_health("templates", src.templates(spark, d), ["template"], None, AS_OF),
        quality.table_health("sends", sem.facts(spark, d), ["message_id"], F.col("sent_date"), AS_OF),
        quality.table_health("reports", landed, ["message_id"], F.col("ingestion_date"), AS_OF), quality.table_health("features", rk.store(spark, d), ["account_page", "template"], F.col("computed_date"), AS_OF)])


@product(
    "visible_pages", "page_id:i words:i",
    """SELECT page_id, len(regexp_extract_all(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\\b.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&[A-Za-z0-9#]+;', ' ', 'g'), '\\s+', ' ', 'g')), '[\\p{L}\\p{N}]+')) AS words FROM pages""",
)
def _(spark, d):
    p = src.spread(src.table(spark, d, "pages").select("page_id", "html"), "page_id")
    return p.select("page_id", text.word_count(text.strip_html("html")).alias("words"))
