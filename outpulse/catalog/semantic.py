"""Registered queries: daily performance, profiles, text features."""

from __future__ import annotations

from pyspark.sql import functions as F

from outpulse.catalog.base_sql import ratio
from outpulse.catalog.registry import SHARED_SQL, layer, product
from outpulse.plans import ingest, semantic
from outpulse.sources import driver_tables as src

AS_OF = src.EVENTS_AS_OF
NOW = "TIMESTAMP '2024-01-31'"
TODAY = "DATE '2024-01-31'"


def facts(spark, d):
    return src.send_facts(spark, d)


@layer("dm_sends")
def dm(spark, d):
    sends = ingest.dm_send_facts(facts(spark, d), src.accounts(spark, d), AS_OF, 28)
    # What its readers need; ids and further rates are not stored.
    return sends.select("account_page", "template", "sent_at", "local_at", "dow", "hod", "kind", "price", "sent", "purchased", "earnings", "rps")


def local(spark, d, days=180):
    return ingest.local_sends(facts(spark, d), src.accounts(spark, d), AS_OF, days)


def features(spark, d):
    return semantic.template_features(src.spread(src.templates(spark, d), "template"))


@layer("used_features")
def used_features(spark, d):
    return semantic.template_features(semantic.in_play(src.templates(spark, d), facts(spark, d)))


@layer("daily_performance")
def daily(spark, d):
    return semantic.daily_performance(
        facts(spark, d), src.accounts(spark, d), src.templates(spark, d), AS_OF
    )


SHARED_SQL["c_valid"] = "SELECT * FROM c_facts WHERE sent > 0 AND viewed <= sent AND purchased <= viewed"
SHARED_SQL["c_dm28"] = f"SELECT * FROM c_dm WHERE sent_at >= {NOW} - INTERVAL 28 DAY"
SHARED_SQL["c_local"] = f"""
SELECT f.*, CAST(local_at AS DATE) AS local_date, (dayofweek(local_at) + 6) % 7 AS dow, hour(local_at) AS hod,
  {ratio('earnings', 'sent')} AS rps
FROM (SELECT c_facts.*, sent_at + to_hours(CAST(utc_offset AS BIGINT)) AS local_at
      FROM c_facts JOIN c_accounts USING (account) WHERE is_active AND sent_at < {NOW}) f"""

SHARED_SQL["c_daily_base"] = f"""
SELECT sent_date AS metric_date, template, account, account_page, category, count(*) AS sends, sum(sent) AS sent,
  sum(viewed) AS viewed, sum(purchased) AS purchased, CAST(sum(earnings) AS DOUBLE) AS revenue, avg(price::DOUBLE) AS avg_price,
  {ratio('sum(viewed)', 'sum(sent)')} AS view_rate, {ratio('sum(purchased)', 'sum(sent)')} AS purchase_rate,
  CAST(sum(earnings) AS DOUBLE) * 0.8 / sum(sent) AS rps,
  quantile_disc(earnings::DOUBLE * 0.8 / sent, 0.5) AS median_rps, quantile_disc(earnings::DOUBLE * 0.8 / sent, 0.75) AS p75_rps,
  quantile_disc(earnings::DOUBLE * 0.8 / sent, 0.25) AS p25_rps
FROM c_valid JOIN c_templates USING (template) JOIN c_accounts USING (account)
WHERE sent_at < {NOW} GROUP BY 1, 2, 3, 4, 5"""

SHARED_SQL["c_hourly"] = f"""
SELECT account, template, sent_date AS metric_date, hour(sent_at) AS hour, sum(sent) AS sends,
  CAST(sum(earnings) AS DOUBLE) * 0.8 / sum(sent) AS rps
FROM c_valid WHERE sent_at < {NOW} GROUP BY 1, 2, 3, 4"""

SHARED_SQL["c_daily"] = f"""
SELECT *, CASE WHEN pct_in_category >= 0.9 THEN 'top_performer' WHEN pct_in_category >= 0.7 THEN 'strong_performer'
               WHEN pct_in_category >= 0.3 THEN 'average_performer' ELSE 'under_performer' END AS performance_tier
FROM (SELECT *, CASE WHEN rps_30 > 0 THEN 1 - least(1, abs(p75_rps - p25_rps) / (2 * rps_30)) ELSE 0 END AS stability,
  percent_rank() OVER (PARTITION BY account, metric_date ORDER BY rps) AS pct_in_account,
  percent_rank() OVER (PARTITION BY category, metric_date ORDER BY rps) AS pct_in_category,
  {TODAY} - max(metric_date) OVER (PARTITION BY account, template) AS days_since_use
FROM (SELECT *, avg(rps) OVER (w ROWS 6 PRECEDING) AS rps_7, avg(purchase_rate) OVER (w ROWS 6 PRECEDING) AS purchase_rate_7,
  avg(rps) OVER (w ROWS 29 PRECEDING) AS rps_30,
  coalesce((avg(rps) OVER (w ROWS 14 PRECEDING) - avg(rps) OVER (w ROWS BETWEEN 29 PRECEDING AND 15 PRECEDING))
    / nullif(avg(rps) OVER (w ROWS BETWEEN 29 PRECEDING AND 15 PRECEDING), 0), 0) AS trend
FROM c_daily_base WINDOW w AS (PARTITION BY account, template ORDER BY metric_date)))"""


@product(
    "daily_performance",
    "metric_date:d template account account_page category sends:i sent:i viewed:i purchased:i revenue:r avg_price:r view_rate:r "
    "purchase_rate:r rps:r median_rps:r p75_rps:r p25_rps:r rps_7:r purchase_rate_7:r rps_30:r trend:r stability:r "
    "pct_in_account:r pct_in_category:r days_since_use:i hours performance_tier",
    """SELECT *, (SELECT string_agg(hour || ':' || sends, ',' ORDER BY hour) FROM c_hourly h WHERE h.account = d.account
         AND h.template = d.template AND h.metric_date = d.metric_date) AS hours FROM c_daily d""",
)
def _(spark, d):
    return daily(spark, d).selectExpr(
        "*", "array_join(transform(hourly, h -> concat(h.hour, ':', h.sends)), ',') AS hours"
    )


@product(
    "template_features",
    "template words:i emojis:i length_bin emoji_bin has_cta has_urgency ends_with_question content_level theme_tags",
    "SELECT * FROM c_features",
)
def _(spark, d):
    return features(spark, d)


SHARED_SQL["c_engagement"] = f"""
SELECT *, energy * 0.4 + least(emoji_density / 10, 1.0) * 0.2 + intensity / 3.0 * 0.3 + has_question * 0.1 AS engagement FROM (
SELECT *, (urgency + closeness + action) / 9.0 AS energy, {ratio('emojis', 'body_length')} * 100 AS emoji_density FROM (
SELECT template, emojis, length(body) AS body_length,
  CASE WHEN regexp_matches(lower(body), 'exclusive|limited|now|today|tonight|urgent|hurry|quick|fast|expiring|expires') THEN 3
       WHEN regexp_matches(lower(body), 'special|hot|ready|wait|soon|almost|ending') THEN 2 ELSE 1 END AS urgency,
  CASE WHEN regexp_matches(lower(body), 'love|miss you|thinking of you|dream|imagine|personal|private|just for you') THEN 3
       WHEN regexp_matches(lower(body), 'honey|darling|sweetie|special|close|together') THEN 2 ELSE 1 END AS closeness,
  CASE WHEN regexp_matches(lower(body), 'click|watch|see|check|look|unlock|open|view|download|get|grab') THEN 3
       WHEN regexp_matches(lower(body), 'want|need|ready|come|join|experience|enjoy|try') THEN 2 ELSE 1 END AS action,
  CASE content_level WHEN 'explicit' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END AS intensity,
  CASE WHEN contains(body, '?') THEN 1 ELSE 0 END AS has_question
FROM c_features))"""


@product(
    "engagement_scores",
    "template urgency:i closeness:i action:i emojis:i body_length:i intensity:i has_question:i energy:r emoji_density:r engagement:r",
    "SELECT * FROM c_engagement",
)
def _(spark, d):
    return semantic.engagement_scores(src.spread(src.templates(spark, d), "template"))


SHARED_SQL["c_last_used"] = f"SELECT account, template, max(sent_at) AS last_used_at FROM c_valid WHERE sent_at < {NOW} GROUP BY 1, 2"
SHARED_SQL["c_pairs"] = "SELECT DISTINCT account, template FROM c_facts UNION SELECT owned_by, template FROM c_templates"
SHARED_SQL["c_pool"] = f"""
SELECT p.account, account_page, p.template, f.length_bin, f.emoji_bin, f.has_cta, f.has_urgency, f.ends_with_question, f.category,
  f.content_level, last_used_at, (last_used_at IS NULL OR last_used_at < {NOW} - INTERVAL 7 DAY) AS cooldown_ok
FROM c_pairs p JOIN c_features f USING (template) JOIN c_accounts a USING (account) LEFT JOIN c_last_used u ON u.account = p.account AND u.template = p.template
WHERE list_position(['mild', 'pending_review', 'moderate', 'explicit'], content_level) <=
  CASE page_type WHEN 'free' THEN 2 WHEN 'main' THEN 3 ELSE 4 END"""


@product("template_last_used", "account template last_used_at:t", "SELECT * FROM c_last_used")
def _(spark, d):
    return semantic.last_used(facts(spark, d), AS_OF)


def pool(spark, d):
    sent = facts(spark, d).select("account", "template")
    owned = src.templates(spark, d).select(F.col("owned_by").alias("account"), "template")
    safe = semantic.safe_candidates(features(spark, d), sent.unionByName(owned).distinct(), src.accounts(spark, d))
    return semantic.candidate_pool(safe, semantic.last_used(facts(spark, d), AS_OF), AS_OF, 7)


@product("candidate_pool", "account account_page template content_level length_bin last_used_at:t cooldown_ok", "SELECT * FROM c_pool")
def _(spark, d):
    return pool(spark, d)


SHARED_SQL["c_patterns"] = f"""
SELECT account, 1 - {ratio('sqrt(avg(volatility ** 2))', 'avg(avg_earnings)')} AS consistency, count(*) / 168.0 AS coverage,
  corr(avg_price, conversion) AS price_elasticity, max(conversion) AS peak_conversion, avg(conversion) AS avg_conversion,
  sum(earnings) AS earnings_90d, sum(messages) AS messages_90d,
  array_to_string((list(hour || '@' || weekday ORDER BY coalesce(conversion, -1) DESC, avg_earnings DESC, messages DESC, hour, weekday))[1:10], ',') AS top_windows,
  {ratio('max(conversion) - avg(conversion)', 'avg(conversion)')} AS conversion_volatility,
  CASE WHEN sum(messages) >= 1000 THEN 'HIGH_VOLUME' WHEN sum(messages) >= 300 THEN 'MEDIUM_VOLUME'
       WHEN sum(messages) >= 50 THEN 'LOW_VOLUME' ELSE 'MINIMAL_VOLUME' END AS volume_tier
FROM (SELECT account, hour(sent_at) AS hour, dayofweek(sent_at) + 1 AS weekday, avg({ratio('purchased', 'sent')}) AS conversion,
  avg(price::DOUBLE) AS avg_price, avg(earnings::DOUBLE) AS avg_earnings, stddev_samp(earnings::DOUBLE) AS volatility,
  count(*) AS messages, CAST(sum(earnings) AS DOUBLE) AS earnings
  FROM c_facts WHERE sent_at < {NOW} GROUP BY 1, 2, 3 HAVING count(*) >= 3) GROUP BY 1"""


@product(
    "engagement_patterns",
    "account consistency:r coverage:r price_elasticity:r peak_conversion:r avg_conversion:r earnings_90d:r messages_90d:i "
    "top_windows:j conversion_volatility:r volume_tier",
    "SELECT * REPLACE(string_split(top_windows, ',') AS top_windows) FROM c_patterns",
)
def _(spark, d):
    return semantic.engagement_patterns(facts(spark, d), AS_OF)


SHARED_SQL["c_hour_profile"] = f"""
SELECT *, {ratio('rps', 'avg(rps) OVER (PARTITION BY account)')} AS lift,
  rank() OVER (PARTITION BY account, weekday ORDER BY rps DESC) AS rank_in_day
FROM (SELECT account, dayofweek(sent_at) + 1 AS weekday, hour(sent_at) AS hour, CAST(sum(earnings) AS DOUBLE) / sum(sent) AS rps,
      count(DISTINCT sent_date) AS sample_days FROM c_valid WHERE sent_at < {NOW} GROUP BY 1, 2, 3)"""


@product("hour_profile", "account weekday:i hour:i rps:r sample_days:i lift:r rank_in_day:i", "SELECT * FROM c_hour_profile")
def _(spark, d):
    return semantic.hour_profile(facts(spark, d), AS_OF)


SHARED_SQL["c_behaviour"] = f"""
SELECT account, rev / sent AS rps_28d, bought / sent AS conversion, active_days,
  {ratio('rev / sent - rev0 / sent0', 'rev0 / sent0')} AS slump, coalesce({ratio('coalesce(night, 0)', 'rev')} > 0.35, false) AS night_owl
FROM (SELECT account, CAST(sum(earnings) FILTER (recent) AS DOUBLE) AS rev, CAST(sum(sent) FILTER (recent) AS DOUBLE) AS sent,
  CAST(sum(purchased) FILTER (recent) AS DOUBLE) AS bought, CAST(sum(earnings) FILTER (NOT recent) AS DOUBLE) AS rev0,
  CAST(sum(sent) FILTER (NOT recent) AS DOUBLE) AS sent0,
  CAST(sum(earnings) FILTER (recent AND (hour(sent_at) >= 20 OR hour(sent_at) <= 2)) AS DOUBLE) AS night,
  count(DISTINCT sent_date) FILTER (recent) AS active_days
  FROM (SELECT *, sent_date >= {TODAY} - 28 AS recent FROM c_valid WHERE sent_date BETWEEN {TODAY} - 56 AND {TODAY}) GROUP BY 1)
WHERE sent IS NOT NULL"""


@product("account_behaviour", "account rps_28d:r conversion:r active_days:i slump:r night_owl", "SELECT * FROM c_behaviour")
def _(spark, d):
    return semantic.behaviour(facts(spark, d), AS_OF)


SHARED_SQL["c_intensity"] = f"""
SELECT *, CASE WHEN score > 5 THEN 'high' WHEN score > 3 THEN 'medium' ELSE 'low' END AS tier FROM (
SELECT *, 0.3 * ln(1 + earnings) + 0.2 * ln(1 + spend_per_txn) + 0.2 * ln(1 + earn_per_day) + 0.2 * 0.7 + 0.1 * ln(1 + active_days) AS score
FROM (SELECT account, CAST(sum(earnings) AS DOUBLE) / sum(sent) AS rps_7d, CAST(sum(earnings) AS DOUBLE) AS earnings,
  {ratio('sum(earnings)', 'sum(purchased)')} AS spend_per_txn, {ratio('sum(earnings)', 'count(DISTINCT sent_date)')} AS earn_per_day,
  count(DISTINCT sent_date) AS active_days FROM c_valid WHERE sent_date BETWEEN {TODAY} - 7 AND {TODAY} GROUP BY 1))"""


@product(
    "account_intensity", "account rps_7d:r earnings:r spend_per_txn:r earn_per_day:r active_days:i score:r tier", "SELECT * FROM c_intensity"
)
def _(spark, d):
    return semantic.intensity(facts(spark, d), AS_OF)


SHARED_SQL["c_health"] = f"""
SELECT account, active_fans::DOUBLE AS active_fans, coalesce(e, 0) AS earnings, coalesce(e, 0) * 0.8 AS message_net,
  coalesce({ratio('e', 'active_fans')}, 0) AS earn_per_fan, coalesce({ratio('e', 'b')}, 0) AS spend_per_txn, renew_on_pct, log10(1 + active_fans) AS log_fans
FROM c_accounts LEFT JOIN (SELECT account, CAST(sum(earnings) AS DOUBLE) AS e, sum(purchased) AS b FROM c_facts
  WHERE sent_date BETWEEN {TODAY} - 7 AND {TODAY} GROUP BY 1) USING (account)"""
_z = " + ".join(
    f"{w} * coalesce(({c} - (SELECT avg({c}) FROM c_health)) / nullif((SELECT stddev_samp({c}) FROM c_health), 0), 0)"
    for c, w in semantic.TIER_WEIGHTS.items()
)
SHARED_SQL["c_scored_health"] = f"SELECT *, {_z} AS intensity FROM c_health"
SHARED_SQL["c_thresholds"] = """
SELECT count(*) AS population, quantile_disc(intensity, 0.4) AS q40, quantile_disc(intensity, 0.6) AS q60, quantile_disc(intensity, 0.9) AS q90,
  quantile_disc(active_fans, 0.7) AS fans_p70, quantile_disc(message_net, 0.6) AS net_p60, quantile_disc(message_net, 0.7) AS net_p70,
  quantile_disc(earnings, 0.7) AS earn_p70 FROM c_scored_health"""


def scored_health(spark, d):
    return semantic.scored_health(semantic.account_health(facts(spark, d), src.accounts(spark, d), AS_OF))


@product("tier_thresholds", "population:i q40:r q60:r q90:r fans_p70:r net_p60:r net_p70:r earn_p70:r", "SELECT * FROM c_thresholds")
def _(spark, d):
    return semantic.tier_thresholds(scored_health(spark, d))


@product(
    "tier_assignment",
    "account intensity:r earnings:r active_fans:r tier",
    """SELECT h.*, CASE WHEN message_net = 0 AND earnings = 0 AND active_fans < 100 THEN 'LOW'
      WHEN intensity >= q90 AND active_fans >= fans_p70 AND (message_net >= net_p70 OR earnings >= earn_p70) THEN 'POWER'
      WHEN intensity >= q60 AND (message_net >= net_p60 OR active_fans >= 0.8 * fans_p70) THEN 'HIGH'
      WHEN intensity >= q40 THEN 'MED' ELSE 'LOW' END AS tier FROM c_scored_health h, c_thresholds""",
)
def _(spark, d):
    return semantic.tier_assignment(scored_health(spark, d))


SHARED_SQL["c_fatigue"] = f"""
SELECT *, CASE WHEN fatigue >= 0.8 THEN 'BURNT_OUT' WHEN fatigue >= 0.5 THEN 'FATIGUED' WHEN fatigue >= 0.3 THEN 'MODERATE' ELSE 'FRESH' END AS fatigue_tier
FROM (SELECT *, CASE WHEN uses >= 8 THEN 1.0 WHEN uses >= 5 THEN 0.8 WHEN uses >= 3 THEN 0.5 WHEN uses >= 2 THEN 0.3 ELSE 0.1 END::DOUBLE
    * greatest(1.2::DOUBLE - days_since_use / 30.0::DOUBLE, 0.5) AS fatigue
FROM (SELECT account, template, count(*) AS uses, max(sent_at) AS last_at, count(DISTINCT sent_date) AS use_days,
  (CAST(max(sent_at) AS DATE) - CAST(min(sent_at) AS DATE)) / greatest(count(*) - 1, 1) AS days_between_uses,
  count(*) / count(DISTINCT sent_date) AS density, {TODAY} - CAST(max(sent_at) AS DATE) AS days_since_use
  FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 30 DAY AND sent_at < {NOW} GROUP BY 1, 2))"""


@product(
    "fatigue_scores",
    "account template uses:i last_at:t use_days:i days_between_uses:r density:r days_since_use:i fatigue:r fatigue_tier",
    "SELECT * FROM c_fatigue",
)
def _(spark, d):
    return semantic.fatigue_scores(facts(spark, d), AS_OF)


_W = f"0.5 ** (floor(epoch({NOW} - sent_at) / 86400) / 45.0)"
SHARED_SQL["c_style"] = f"""
SELECT *, CASE WHEN lift_smooth IS NOT NULL THEN greatest(-0.5, least(0.5, lift_smooth)) END AS lift_clamped FROM (
SELECT a.*, baseline, {ratio('rps_w', 'baseline')} - 1 AS lift,
  {ratio('(weight * rps_w + 30 * baseline) / (weight + 30)', 'baseline')} - 1 AS lift_smooth
FROM (SELECT account_page, dow, hod, length_bin, emoji_bin, has_cta, has_urgency, ends_with_question, count(*) AS sends, sum({_W}) AS weight,
  sum(rps * {_W}) / sum({_W}) AS rps_w FROM c_dm28 JOIN c_features USING (template) GROUP BY ALL) a
JOIN (SELECT account_page, dow, hod, sum(rps * {_W}) / sum({_W}) AS baseline FROM c_dm28 GROUP BY ALL) USING (account_page, dow, hod))"""


@product(
    "style_lift",
    "account_page dow:i hod:i length_bin emoji_bin has_cta has_urgency ends_with_question sends:i weight:r rps_w:r baseline:r lift:r lift_smooth:r lift_clamped:r",
    "SELECT * FROM c_style",
)
def _(spark, d):
    return semantic.style_lift(dm(spark, d), used_features(spark, d), AS_OF)


SHARED_SQL["c_dow_hod"] = f"SELECT account, dow, hod, sum(earnings::DOUBLE * exp(-({TODAY} - local_date) / 60.0)) AS score FROM c_local GROUP BY 1, 2, 3"


@product("weekday_hour_scores", "account dow:i hod:i score:r", "SELECT * FROM c_dow_hod")
def _(spark, d):
    return semantic.weekday_hour_scores(local(spark, d), AS_OF)


SHARED_SQL["c_price_profile"] = """
SELECT *, CASE WHEN price_corr > 0.2 THEN 'premium' WHEN price_corr < -0.2 THEN 'value' ELSE 'balanced' END AS price_mode FROM (
SELECT account, quantile_disc(price::DOUBLE, 0.35) AS p35, quantile_disc(price::DOUBLE, 0.5) AS p50, quantile_disc(price::DOUBLE, 0.6) AS p60,
  quantile_disc(price::DOUBLE, 0.8) AS p80, quantile_disc(price::DOUBLE, 0.9) AS p90, corr(price::DOUBLE, rps) AS price_corr
FROM c_local WHERE price > 0 GROUP BY 1)"""


@product("price_profile", "account p35:r p50:r p60:r p80:r p90:r price_corr:r price_mode", "SELECT * FROM c_price_profile")
def _(spark, d):
    return semantic.price_profile(local(spark, d))


SHARED_SQL["c_decayed"] = f"SELECT account_page, template, sum(sent * {_W}) AS decayed_sent, sum(purchased * {_W}) AS decayed_bought FROM c_dm28 GROUP BY 1, 2"
SHARED_SQL["c_priors"] = f"SELECT account_page, {ratio('sum(purchased)', 'sum(sent)')} AS mu_buy FROM c_dm28 GROUP BY 1"


@product(
    "decayed_template_stats",
    "account_page template decayed_sent:r decayed_bought:r mu_buy:r",
    "SELECT * FROM c_decayed JOIN c_priors USING (account_page)",
)
def _(spark, d):
    sends = dm(spark, d)
    return semantic.decayed_template_stats(sends, AS_OF).join(semantic.account_priors(sends), "account_page")


SHARED_SQL["c_curve"] = """
SELECT *, price_q * p_buy AS rps_eb, price_q * (p_buy - sqrt(greatest(p_buy * (1 - p_buy), 0) / (sent + 200))) AS rps_lcb FROM (
SELECT c.*, (bought + 200 * mu_buy) / (sent + 200) AS p_buy
FROM (SELECT account_page, dow, hod, ceil(price::DOUBLE / 10) * 10 AS price_q, sum(sent) AS sent, sum(purchased) AS bought
      FROM c_dm28 WHERE kind = 'paid' GROUP BY ALL) c JOIN c_priors USING (account_page))"""
SHARED_SQL["c_best_price"] = """
SELECT * FROM c_curve QUALIFY row_number() OVER (PARTITION BY account_page, dow, hod ORDER BY rps_lcb DESC, price_q) = 1"""


@product(
    "price_curve", "account_page dow:i hod:i price_q:r sent:i bought:i p_buy:r rps_eb:r rps_lcb:r", "SELECT * FROM c_curve"
)
def _(spark, d):
    return semantic.price_curve(dm(spark, d))


@product("best_prices", "account_page dow:i hod:i price_q:r p_buy:r rps_lcb:r", "SELECT * FROM c_best_price")
def _(spark, d):
    return semantic.best_prices(semantic.price_curve(dm(spark, d)))


SHARED_SQL["c_scorecard"] = f"""
SELECT account_page, dow, hod, sent, rps_free,
  (rev + 50 * (sum(rev) OVER w / sum(sent) OVER w)) / (sent + 50) AS slot_score,
  (bought + 50 * (sum(bought) OVER w / sum(sent) OVER w)) / (sent + 50) AS conversion_smooth
FROM (SELECT account_page, dow, hod, CAST(sum(earnings) AS DOUBLE) AS rev, sum(sent) AS sent, sum(purchased)::DOUBLE AS bought,
  coalesce({ratio("sum(earnings) FILTER (kind = 'free')", "sum(sent) FILTER (kind = 'free')")}, 0) AS rps_free FROM c_dm28 GROUP BY 1, 2, 3)
WINDOW w AS (PARTITION BY account_page)"""


@product("slot_scorecard", "account_page dow:i hod:i sent:i rps_free:r slot_score:r conversion_smooth:r", "SELECT * FROM c_scorecard")
def _(spark, d):
    return semantic.slot_scorecard(dm(spark, d))


SHARED_SQL["c_volume_profile"] = f"""
SELECT *, CASE WHEN slope >= 12 AND fatigue_ratio >= 0.7 THEN 1.5 WHEN slope >= 8 AND fatigue_ratio >= 0.65 THEN 1.3 WHEN slope >= 4 THEN 1.15
  WHEN slope <= 1 OR fatigue_ratio < 0.5 THEN 0.9 ELSE 1.0 END AS volume_boost FROM (
SELECT account, avg(n) AS avg_per_day, quantile_disc(n::DOUBLE, 0.9) AS q90_per_day, corr(n, rev) AS corr_volume_revenue,
  CASE WHEN var_pop(n) = 0 THEN 0 ELSE covar_pop(n, rev) / var_pop(n) END AS slope,
  coalesce({ratio('avg(last_rev) FILTER (n >= 2)', 'avg(first_rev) FILTER (n >= 2)')}, 1) AS fatigue_ratio
FROM (SELECT account, local_date, count(*) FILTER (price > 0) AS n, coalesce(CAST(sum(earnings) FILTER (price > 0) AS DOUBLE), 0) AS rev,
  min_by(earnings::DOUBLE, (local_at, message_id)) FILTER (price > 0) AS first_rev, max_by(earnings::DOUBLE, (local_at, message_id)) FILTER (price > 0) AS last_rev
  FROM c_local WHERE sent_at >= {NOW} - INTERVAL 28 DAY GROUP BY 1, 2) GROUP BY 1)"""


@product(
    "volume_profile",
    "account avg_per_day:r q90_per_day:r corr_volume_revenue:r slope:r fatigue_ratio:r volume_boost:r",
    "SELECT * FROM c_volume_profile",
)
def _(spark, d):
    return semantic.volume_profile(local(spark, d, 28))


@product(
    "assignee_kpis",
    "assignee revenue_7d:r revenue_28d:r messages_7d:i messages_28d:i",
    f"""SELECT assignee, sum(CASE WHEN sent_at >= {NOW} - INTERVAL 7 DAY THEN earnings ELSE 0 END) AS revenue_7d, sum(earnings) AS revenue_28d,
      count(*) FILTER (sent_at >= {NOW} - INTERVAL 7 DAY) AS messages_7d, count(*) AS messages_28d
    FROM c_facts JOIN c_accounts USING (account) WHERE sent_at >= {NOW} - INTERVAL 28 DAY AND sent_at < {NOW} GROUP BY 1""",
)
def _(spark, d):
    return semantic.assignee_kpis(facts(spark, d), src.accounts(spark, d), AS_OF)


SHARED_SQL["c_signals"] = f"""
WITH mf AS (SELECT * FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 28 DAY AND sent_at < {NOW}),
  late AS (SELECT account, count(*) AS n, CAST(sum(earnings) AS DOUBLE) AS e FROM mf WHERE sent_date >= {TODAY} - 14 GROUP BY 1),
  early AS (SELECT account, count(*) AS n, CAST(sum(earnings) AS DOUBLE) AS e FROM mf WHERE sent_date < {TODAY} - 14 GROUP BY 1)
SELECT p.*, late.e / late.n AS rps_recent, early.e / early.n AS rps_previous, (late.e - early.e) / nullif(early.e, 0) AS lift
FROM (SELECT account, count(*) AS sends, CAST(sum(earnings) AS DOUBLE) AS earnings, CAST(sum(earnings) AS DOUBLE) / count(*) AS rps,
  quantile_disc(price::DOUBLE, 0.5) AS p50_price, count(*) FILTER (earnings > 0) / count(*) AS sell_rate FROM mf GROUP BY 1) p
LEFT JOIN (late FULL JOIN early USING (account)) USING (account)"""


@product(
    "learning_signals",
    "account sends:i earnings:r rps:r p50_price:r sell_rate:r rps_recent:r rps_previous:r lift:r",
    "SELECT * FROM c_signals",
)
def _(spark, d):
    return semantic.learning_signals(facts(spark, d), AS_OF)


@product(
    "knob_changes",
    "account quota_step:i hour_pool_step:i price_bias",
    """SELECT account, CASE WHEN lift >= 0.15 THEN 1 WHEN lift <= -0.15 THEN -1 ELSE 0 END AS quota_step,
      CASE WHEN sell_rate >= 0.2 THEN 1 WHEN sell_rate < 0.08 THEN -1 ELSE 0 END AS hour_pool_step,
      CASE WHEN lift >= 0.15 AND sell_rate >= 0.2 THEN 'up' WHEN lift <= -0.15 THEN 'down' ELSE 'hold' END AS price_bias FROM c_signals""",
)
def _(spark, d):
    return semantic.knob_changes(semantic.learning_signals(facts(spark, d), AS_OF))
