"""Registered queries: alerts, volume, timing and revenue advice."""

from __future__ import annotations

from outpulse.catalog import planning as pl
from outpulse.catalog import semantic as sem
from outpulse.catalog.base_sql import ratio
from outpulse.catalog.registry import SHARED_SQL, layer, product
from outpulse.catalog.semantic import AS_OF, NOW, TODAY
from outpulse.plans import advice, semantic
from outpulse.sources import driver_tables as src


def _present(*pairs) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{v}' END" for c, v in pairs) + "], lambda x: x IS NOT NULL)"


_HOURS = f"(epoch_us({NOW}) - epoch_us(latest_at)) // 3600000000"
SHARED_SQL["c_alerts"] = f"""
WITH dt AS (SELECT account, sent_date, late, CAST(sum(earnings) AS DOUBLE) AS revenue, sum(sent) AS sent, sum(purchased) AS purchased, count(DISTINCT template) AS templates,
    avg({ratio('purchased', 'sent')}) AS mean_conversion, max(sent_at) AS latest_at, {ratio('sum(purchased)', 'sum(sent)')} AS conversion
  FROM (SELECT *, sent_at >= {NOW} - INTERVAL 7 DAY AS late FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 30 DAY AND sent_at < {NOW}) GROUP BY 1, 2, 3),
b AS (SELECT account, avg(revenue) AS exp_revenue, stddev_samp(revenue) AS sd_revenue, quantile_disc(revenue, 0.25) AS p25, quantile_disc(revenue, 0.75) AS p75,
    quantile_disc(revenue, 0.9) AS p90, avg(conversion) AS exp_conversion, stddev_samp(conversion) AS sd_conversion, quantile_disc(conversion, 0.25) AS conv_p25,
    avg(sent) AS exp_sent, stddev_samp(sent) AS sd_sent, avg(templates) AS exp_templates FROM dt WHERE NOT late GROUP BY 1 HAVING count(*) >= 10),
j AS (SELECT dt.*, b.* EXCLUDE (account), (revenue - exp_revenue) / nullif(sd_revenue, 0) AS revenue_z, (mean_conversion - exp_conversion) / nullif(sd_conversion, 0) AS conversion_z,
    (sent - exp_sent) / nullif(sd_sent, 0) AS volume_z, {_HOURS} > 8 AS stale FROM dt JOIN b USING (account) WHERE late)
SELECT *, CASE WHEN revenue < p25 AND revenue_z < -2 THEN 'CRITICAL_LOW' WHEN revenue < exp_revenue - sd_revenue THEN 'WARNING' WHEN revenue > p90 THEN 'EXCEEDING'
    WHEN revenue > p75 THEN 'GOOD' ELSE 'NORMAL' END AS status,
  {_present(('mean_conversion < conv_p25', 'low_conversion'), ('templates < exp_templates * 0.7', 'low_diversity'), ('sent < exp_sent * 0.8', 'low_volume'), ('stale', 'stale_activity'),
            ('revenue_z < -1.5', 'revenue_concern'), ('conversion_z < -1.5', 'conversion_concern'))} AS issues,
  CASE WHEN revenue < p25 THEN 'deploy_winners' WHEN mean_conversion < conv_p25 THEN 'improve_conversion' WHEN templates < exp_templates * 0.7 THEN 'rotate_more'
    WHEN sent < exp_sent * 0.8 THEN 'raise_volume' WHEN stale THEN 'check_activity' ELSE 'monitor' END AS action,
  CASE WHEN revenue_z IS NOT NULL THEN least(100, greatest(0, 50 - round(revenue_z * 15) + CASE WHEN mean_conversion < conv_p25 THEN 20 ELSE 0 END
    + CASE WHEN templates < exp_templates * 0.7 THEN 15 ELSE 0 END + CASE WHEN stale THEN 25 ELSE 0 END)) END AS severity FROM j"""


def alerts(spark, d):
    return advice.performance_alerts(sem.facts(spark, d), AS_OF)


@product("performance_alerts", "account sent_date:d revenue:r exp_revenue:r revenue_z:r conversion_z:r volume_z:r status issues:j action severity:r", "SELECT * FROM c_alerts")
def _(spark, d):
    return alerts(spark, d)


SHARED_SQL["c_recovery"] = f"""
SELECT *, row_number() OVER (PARTITION BY account ORDER BY recovery_score DESC, template) AS rank FROM (
SELECT h.*, old_conversion * 0.4 + avg_earnings / 50 * 0.3 + least(1, old_uses / 10) * 0.2 + coalesce(engagement, 0.5) * 0.1 AS recovery_score,
  CASE WHEN severity >= 80 THEN 'EMERGENCY_RECOVERY' WHEN status = 'CRITICAL_LOW' THEN 'AGGRESSIVE_RECOVERY' ELSE 'PROACTIVE_ADJUSTMENT' END AS kind
FROM (SELECT account, template, status, severity, avg({ratio('purchased', 'sent')}) FILTER (NOT late) AS old_conversion, avg(earnings::DOUBLE) FILTER (NOT late) AS avg_earnings,
    count(*) FILTER (NOT late) AS old_uses, count(*) FILTER (late) AS recent_uses
  FROM (SELECT f.*, a.status, a.severity, sent_at >= {NOW} - INTERVAL 7 DAY AS late FROM c_facts f JOIN (SELECT account, status, severity FROM c_alerts WHERE sent_date = {TODAY} - 1
    AND (status IN ('CRITICAL_LOW', 'WARNING') OR severity > 60)) a USING (account) WHERE sent_at < {NOW}) GROUP BY 1, 2, 3, 4) h
LEFT JOIN c_engagement USING (template) WHERE old_conversion > 0.05 AND old_uses >= 2 AND recent_uses < 2) QUALIFY rank <= 10"""


def recovery(spark, d):
    f = sem.facts(spark, d)
    eng = semantic.engagement_scores(semantic.in_play(src.templates(spark, d), f))
    return advice.recovery_candidates(alerts(spark, d), f, pl.cooldowns(spark, d), eng, AS_OF)


@product("recovery_candidates", "account template kind old_conversion:r avg_earnings:r recovery_score:r rank:i", "SELECT * FROM c_recovery")
def _(spark, d):
    return recovery(spark, d)


@product(
    "intervention_log", "account kind severity:r winners:i avg_conversion:r templates:j",
    """SELECT account, kind, severity, count(*) AS winners, avg(old_conversion) AS avg_conversion, list(template ORDER BY rank) AS templates FROM c_recovery
       WHERE recovery_score > 0.3 GROUP BY 1, 2, 3""",
)
def _(spark, d):
    return advice.intervention_log(recovery(spark, d))


@product(
    "system_health",
    "day_accounts:i day_messages:i day_earnings:r day_conversion:r day_templates:i pairs:i ready:i burnt_out:i elite:i avg_cooldown:r alerts_critical:i alerts_warning:i conversion_score:i content_score:i alert_score:i",
    f"""SELECT *, CASE WHEN day_accounts = 0 THEN 0 WHEN day_conversion < 0.02 THEN 30 WHEN day_conversion < 0.05 THEN 60 WHEN day_conversion < 0.08 THEN 80 ELSE 95 END AS conversion_score,
      CASE WHEN ready < 100 THEN 20 WHEN ready < 500 THEN 60 WHEN ready < 1000 THEN 80 ELSE 95 END AS content_score,
      CASE WHEN alerts_critical > 5 THEN 10 WHEN alerts_critical > 2 THEN 40 WHEN alerts_warning > 10 THEN 60 WHEN alerts_severity > 60 THEN 70 ELSE 90 END AS alert_score
    FROM (SELECT count(DISTINCT account) AS day_accounts, count(*) AS day_messages, sum(earnings) AS day_earnings, avg({ratio('purchased', 'sent')}) AS day_conversion,
        count(DISTINCT template) AS day_templates FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 1 DAY AND sent_at < {NOW}),
      (SELECT count(*) AS pairs, count(*) FILTER (available_after <= {NOW}) AS ready, count(*) FILTER (fatigue >= 0.8) AS burnt_out, count(*) FILTER (performance_tier = 'ELITE') AS elite,
        avg(cooldown_days) AS avg_cooldown FROM c_cooldowns),
      (SELECT count(*) FILTER (status = 'CRITICAL_LOW') AS alerts_critical, count(*) FILTER (status = 'WARNING') AS alerts_warning, avg(severity) AS alerts_severity
        FROM c_alerts WHERE sent_date = {TODAY} - 1)""",
)
def _(spark, d):
    return advice.system_health(sem.facts(spark, d), pl.cooldowns(spark, d), alerts(spark, d), AS_OF)


SHARED_SQL["c_volume"] = f"""
WITH p AS (SELECT account, avg(purchased / sent) AS conversion, avg(earnings::DOUBLE / sent) AS rps, count(*) AS sends, stddev_samp(purchased / sent) AS volatility,
    avg(purchased / sent) FILTER (late) AS new_conv, avg(purchased / sent) FILTER (NOT late) AS old_conv
  FROM (SELECT *, sent_at >= {NOW} - INTERVAL 10 DAY AS late FROM c_facts WHERE sent > 0 AND sent_at < {NOW}) GROUP BY 1),
j AS (SELECT a.account, account_page, a.tier, page_state, active_fans, renew_on_pct, daily_quota, coalesce(conversion, 0) AS conversion, coalesce(rps, 0) AS rps, coalesce(sends, 0) AS sends,
    coalesce(volatility, 1) AS v, coalesce(volume_tier, 'MINIMAL_VOLUME') AS volume_tier, coalesce(coverage, 0) AS s, coalesce(new_conv, 0) / nullif(coalesce(old_conv, 0), 0) AS t
  FROM c_accounts a LEFT JOIN p USING (account) LEFT JOIN c_patterns USING (account)),
m AS (SELECT *, CASE WHEN tier = 'high' AND conversion > 0.15 AND active_fans > 500 AND volume_tier = 'HIGH_VOLUME' THEN 10 WHEN tier = 'high' AND conversion > 0.12 AND active_fans > 200 THEN 8
    WHEN page_state = 'grow' AND conversion > 0.08 THEN 6 WHEN tier = 'medium' AND conversion > 0.1 AND volume_tier IN ('MEDIUM_VOLUME', 'HIGH_VOLUME') THEN 5
    WHEN tier = 'medium' AND conversion > 0.08 THEN 4 WHEN page_state = 'retain' AND renew_on_pct < 0.25 THEN 3 WHEN sends < 50 OR conversion < 0.05 THEN 2
    WHEN tier = 'high' THEN 6 WHEN tier = 'medium' THEN 4 ELSE 3 END AS base_volume,
  (CASE WHEN t > 1.2 THEN 1.2 WHEN t > 1.1 THEN 1.1 WHEN t < 0.8 THEN 0.8 WHEN t < 0.9 THEN 0.9 ELSE 1 END)::DOUBLE AS trend_mult,
  (CASE WHEN v < 0.05 THEN 1.1 WHEN v < 0.1 THEN 1.05 WHEN v > 0.3 THEN 0.9 WHEN v > 0.2 THEN 0.95 ELSE 1 END)::DOUBLE AS stability_mult,
  (CASE WHEN s > 0.5 THEN 1.1 WHEN s > 0.3 THEN 1.05 WHEN s < 0.1 THEN 0.9 ELSE 1 END)::DOUBLE AS coverage_mult FROM j)
SELECT *, recommended - daily_quota AS change, CASE WHEN recommended >= 8 THEN 'high' WHEN recommended >= 6 THEN 'medium_high' WHEN recommended >= 4 THEN 'standard'
    WHEN recommended >= 3 THEN 'conservative' ELSE 'minimal' END AS band,
  CASE WHEN sends >= 100 AND v < 0.15 THEN 'HIGH' WHEN sends >= 50 AND v < 0.25 THEN 'MEDIUM' WHEN sends >= 20 THEN 'LOW' ELSE 'VERY_LOW' END AS confidence
FROM (SELECT *, greatest(2, least(12, round(base_volume * trend_mult * stability_mult * coverage_mult))) AS recommended FROM m)"""


@layer("volume_advice")
def volume(spark, d):
    f = sem.facts(spark, d)
    return advice.volume_advice(f, src.accounts(spark, d), semantic.engagement_patterns(f, AS_OF), AS_OF)


@product(
    "volume_advice", "account tier conversion:r rps:r sends:i base_volume:i trend_mult:r stability_mult:r coverage_mult:r recommended:i change:i band confidence", "SELECT * FROM c_volume"
)
def _(spark, d):
    return volume(spark, d)


SHARED_SQL["c_weekday_volume"] = f"""
SELECT *, weekday_volume - recommended AS adjustment FROM (SELECT *, greatest(1, least(15, round(recommended * CASE WHEN r > 1.3 THEN 1.4 WHEN r > 1.15 THEN 1.2 WHEN r > 1.05 THEN 1.1 WHEN r < 0.7 THEN 0.7 WHEN r < 0.85 THEN 0.85 ELSE 1 END::DOUBLE))) AS weekday_volume,
  CASE WHEN r > 1.3 THEN 'strong' WHEN r > 1.15 THEN 'good' WHEN r > 1.05 THEN 'above_average' WHEN r < 0.7 THEN 'weak' WHEN r < 0.85 THEN 'below_average' WHEN sends < 5 THEN 'limited_data' ELSE 'average' END AS note
FROM (SELECT v.account, weekday, recommended, confidence, r AS day_ratio, r, coalesce(c.sends, 0) AS sends FROM (SELECT *, unnest(range(1, 8)) AS weekday FROM c_volume) v
  LEFT JOIN (SELECT *, {ratio('conv', 'avg(conv) OVER (PARTITION BY account)')} AS r FROM (SELECT account, dayofweek(sent_at) + 1 AS weekday, avg(purchased / sent) AS conv, count(*) AS sends
    FROM c_facts WHERE sent > 0 AND sent_at < {NOW} GROUP BY 1, 2)) c USING (account, weekday)))"""


@product("weekday_volume", "account weekday:i recommended:i weekday_volume:i adjustment:i day_ratio:r sends:i note", "SELECT * FROM c_weekday_volume")
def _(spark, d):
    return advice.weekday_volume(sem.facts(spark, d), volume(spark, d), AS_OF)


SHARED_SQL["c_tiers"] = f"""
SELECT *, best * coalesce(rps_mid, rps_low, 5) * 30 AS projected_month FROM (
SELECT *, CASE WHEN rps_high > rps_mid * 1.1 THEN 'VOLUME_BOOST' WHEN rps_low > rps_mid * 1.1 THEN 'VOLUME_SENSITIVE' ELSE 'VOLUME_NEUTRAL' END AS sensitivity,
  CASE WHEN conversion < 0.05 THEN 'LOW_CONVERSION' WHEN sent < 30 THEN 'INSUFFICIENT_DATA' WHEN send_sd > avg_sends THEN 'INCONSISTENT_VOLUME' ELSE 'HEALTHY' END AS quality,
  CASE tier WHEN 'high_volume' THEN CASE WHEN score >= 80 THEN 11 WHEN score >= 60 THEN 9 ELSE 7 END WHEN 'standard' THEN CASE WHEN score >= 70 THEN 7 WHEN score >= 50 THEN 5 ELSE 4 END
    WHEN 'conservative' THEN CASE WHEN score >= 60 THEN 4 WHEN score >= 40 THEN 3 ELSE 2 END ELSE 2 END AS best,
  CASE tier WHEN 'high_volume' THEN CASE WHEN score >= 80 THEN 12 WHEN score >= 60 THEN 10 ELSE 8 END WHEN 'standard' THEN CASE WHEN score >= 70 THEN 8 WHEN score >= 50 THEN 6 ELSE 5 END
    WHEN 'conservative' THEN CASE WHEN score >= 60 THEN 5 WHEN score >= 40 THEN 4 ELSE 3 END ELSE 3 END AS most
FROM (SELECT *, least(100, greatest(0, conversion * 500 + revenue / 100 + CASE WHEN avg_sends > 5 THEN 25 ELSE 0 END)) AS score,
  CASE WHEN conversion >= 0.15 AND revenue >= 2000 THEN 'high_volume' WHEN conversion >= 0.1 AND revenue >= 800 THEN 'standard' WHEN conversion >= 0.05 AND revenue >= 200 THEN 'conservative' ELSE 'minimal' END AS tier
FROM (SELECT account_page, avg(bought / sent) AS conversion, sum(sent) AS sent, sum(rev) AS revenue, count(*) AS active_days, avg(n) AS avg_sends, stddev_samp(n) AS send_sd,
  avg(rev / sent) FILTER (n <= 3) AS rps_low, avg(rev / sent) FILTER (n BETWEEN 4 AND 7) AS rps_mid, avg(rev / sent) FILTER (n >= 8) AS rps_high
  FROM (SELECT account_page, CAST(local_at AS DATE) AS d, count(*) AS n, sum(sent) AS sent, sum(purchased) AS bought, CAST(sum(earnings) AS DOUBLE) AS rev FROM c_dm28 GROUP BY 1, 2) GROUP BY 1)))"""


@product("tiered_volume", "account_page tier score:r conversion:r revenue:r best:i most:i sensitivity quality projected_month:r", "SELECT * FROM c_tiers")
def _(spark, d):
    return advice.tiered_volume(sem.dm(spark, d)).selectExpr("*", "range.optimal AS best", "range.max_sends AS most")


@product(
    "schedule_with_volume", "account_page date_local:d slot_rank:i r:i priority projected:r guidance",
    """SELECT *, CASE WHEN quality = 'LOW_CONVERSION' THEN 'improve_copy' WHEN quality = 'INSUFFICIENT_DATA' THEN 'gather_data' WHEN sensitivity = 'VOLUME_SENSITIVE' THEN 'reduce_volume'
        WHEN sensitivity = 'VOLUME_BOOST' THEN 'increase_volume' WHEN priority = 'EXCESS' THEN 'consider_skipping' ELSE 'keep' END AS guidance
      FROM (SELECT p.account_page, date_local, slot_rank, row_number() OVER (PARTITION BY p.account_page, date_local ORDER BY slot_score DESC NULLS LAST, slot_rank) AS r, quality, sensitivity,
        p.price * coalesce(conversion_smooth, 0.08) AS projected, CASE WHEN r <= coalesce(best, 4) THEN 'RECOMMENDED' WHEN r <= coalesce(most, 6) THEN 'OPTIONAL' ELSE 'EXCESS' END AS priority
        FROM c_plan p LEFT JOIN c_tiers USING (account_page) LEFT JOIN c_scorecard s ON s.account_page = p.account_page AND s.dow = p.dow AND s.hod = p.hod)""",
)
def _(spark, d):
    return advice.schedule_with_volume(pl.plan(spark, d), advice.tiered_volume(sem.dm(spark, d)), semantic.slot_scorecard(sem.dm(spark, d)))


SHARED_SQL["c_timing"] = f"""
WITH s AS (SELECT account, sent_date, hour(sent_at) AS hod, minute(sent_at) AS mi, lag(hour(sent_at), 1) OVER w AS h1, lag(hour(sent_at), 2) OVER w AS h2, lag(minute(sent_at), 1) OVER w AS m1,
    lag(sent_date, 1) OVER w AS d1, count(*) OVER (PARTITION BY account, sent_date) AS same_day
  FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 14 DAY AND sent_at < {NOW} WINDOW w AS (PARTITION BY account ORDER BY sent_at, message_id)),
x AS (SELECT *, abs(hod - coalesce(h1, hod)) AS x1, abs(coalesce(h1, hod) - coalesce(h2, h1, hod)) AS x2 FROM s),
m AS (SELECT account, max_by(hod, (n, -hod)) AS common_hour, max(n) AS common_count FROM (SELECT account, hod, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT account, count(*) AS sends, count(DISTINCT sent_date) AS active_days, count(DISTINCT hod) AS hours_used, count(DISTINCT (hod, mi // 15)) AS windows_used,
    count(DISTINCT dayofweek(sent_date)) AS weekdays_used, count(*) FILTER (x1 <= 1) AS close_times, count(*) FILTER (x1 <= 1 AND x2 <= 1) AS robotic_seq,
    count(*) FILTER (hod = h1 AND abs(mi - m1) <= 5) AS exact_repeats, count(*) FILTER (hod = h1 AND sent_date - d1 = 1) AS same_hour_days, stddev_samp(hod) AS hour_sd,
    avg(same_day) AS avg_per_day, max(same_day) AS max_per_day, count(*) FILTER (same_day > 3) AS burst, count(*) FILTER (hod BETWEEN 6 AND 11) AS morning,
    count(*) FILTER (hod BETWEEN 12 AND 17) AS afternoon, count(*) FILTER (hod BETWEEN 18 AND 23) AS evening, count(*) FILTER (hod BETWEEN 0 AND 5) AS night FROM x GROUP BY 1),
r AS (SELECT *, common_count / sends AS common_ratio FROM a JOIN m USING (account)),
q AS (SELECT *, least(100, CASE WHEN hours_used <= 2 THEN 25 ELSE 0 END + exact_repeats * 5 + least(close_times * 3, 20) + robotic_seq * 8 + same_hour_days * 4
      + CASE WHEN common_ratio > 0.6 THEN 15 WHEN common_ratio > 0.4 THEN 8 ELSE 0 END + CASE WHEN hour_sd < 2 THEN 10 ELSE 0 END + CASE WHEN windows_used <= 3 THEN 8 ELSE 0 END) AS robotic_risk,
    least(100, CASE WHEN greatest(morning, afternoon, evening) > 0.8 * sends THEN 20 ELSE 0 END + CASE WHEN weekdays_used <= 2 AND active_days > 5 THEN 15 ELSE 0 END
      + CASE WHEN burst > active_days * 0.5 THEN 10 ELSE 0 END + CASE WHEN hour_sd < 1.5 THEN 12 ELSE 0 END) AS engagement_risk FROM r)
SELECT *, CASE WHEN risk >= 70 THEN 'CRITICAL' WHEN risk >= 50 THEN 'HIGH' WHEN risk >= 30 THEN 'MEDIUM' WHEN risk >= 15 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level
FROM (SELECT *, greatest(robotic_risk, engagement_risk) AS risk FROM q)"""


@layer("timing_regularity")
def timing(spark, d):
    return advice.timing_regularity(sem.facts(spark, d), AS_OF)


@product(
    "timing_regularity",
    "account sends:i active_days:i hours_used:i windows_used:i weekdays_used:i close_times:i robotic_seq:i exact_repeats:i same_hour_days:i hour_sd:r avg_per_day:r max_per_day:i burst:i "
    "morning:i evening:i common_hour:i common_ratio:r robotic_risk:i engagement_risk:i risk:i risk_level",
    "SELECT * FROM c_timing",
)
def _(spark, d):
    return timing(spark, d)


_RULES = (
    ("ROBOTIC_TIMING", 100, "robotic_seq >= 3"), ("EXACT_REPEATS", 75, "exact_repeats >= 2"), ("HOUR_DOMINANCE", 50, "common_ratio > 0.5"),
    ("CONSECUTIVE_SAME_HOUR", 75, "same_hour_days >= 3"), ("LIMITED_TIME_DIVERSITY", 75, "hours_used <= 2 AND sends >= 8"), ("LOW_TIME_VARIANCE", 50, "hour_sd < 2 AND sends >= 6"),
    ("NARROW_WINDOWS", 50, "windows_used <= 3 AND sends >= 8"), ("TIME_PERIOD_DOMINANCE", 50, "greatest(morning, afternoon, evening) > 0.8 * sends"),
    ("DOW_MONOTONY", 25, "weekdays_used <= 2 AND active_days >= 6"), ("EXCESSIVE_BURSTING", 50, "burst > active_days * 0.6 AND max_per_day > 4"),
)
SHARED_SQL["c_timing_alerts"] = " UNION ALL ".join(
    f"SELECT account, risk_level, risk, '{n}' AS alert, {p} + risk * 0.3 AS priority FROM c_timing WHERE sends >= 3 AND {c}" for n, p, c in _RULES
)


@product("timing_alerts", "account risk_level risk:i alert priority:r", "SELECT * FROM c_timing_alerts")
def _(spark, d):
    return advice.timing_alerts(timing(spark, d))


@product(
    "timing_suggestions", "account risk_level common_hour:i active_hours:j suggested_hours:j unused_hours:j strategy",
    f"""WITH act AS (SELECT account, list_sort(list(DISTINCT hour(sent_at))) AS active_hours FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 14 DAY AND sent_at < {NOW} GROUP BY 1),
      side AS (SELECT account, min_hour, max_hour, active_hours FROM c_accounts LEFT JOIN act USING (account) WHERE is_active),
      perf AS (SELECT account, hour(sent_at) AS hod, count(*) AS n, avg(purchased / sent) AS conv, avg(earnings::DOUBLE / sent) AS rps FROM c_facts WHERE sent > 0 AND sent_at < {NOW} GROUP BY 1, 2),
      b AS (SELECT account, list(hod ORDER BY rk) AS suggested FROM (SELECT p.account, hod, row_number() OVER (PARTITION BY p.account ORDER BY conv DESC, rps DESC, hod) AS rk FROM perf p JOIN side USING (account)
        WHERE hod BETWEEN min_hour AND max_hour AND n >= 2 AND (NOT coalesce(list_contains(active_hours, hod), false) OR conv > 0.08) QUALIFY rk <= 6) GROUP BY 1)
      SELECT account, risk_level, common_hour, active_hours, coalesce(suggested, []) AS suggested_hours,
        coalesce((SELECT (list(h ORDER BY abs(h - 14), h))[1:8] FROM (SELECT unnest(range(min_hour, max_hour + 1)) AS h) WHERE NOT list_contains(active_hours, h)), []) AS unused_hours,
        CASE WHEN risk_level IN ('CRITICAL', 'HIGH') AND hours_used <= 2 THEN 'EMERGENCY' WHEN risk_level = 'HIGH' AND common_ratio > 0.5 THEN 'HIGH_PRIORITY' WHEN risk_level = 'MEDIUM' THEN 'MEDIUM_PRIORITY'
          WHEN risk_level = 'LOW' THEN 'LOW_PRIORITY' ELSE 'GOOD' END AS strategy
      FROM c_timing JOIN side USING (account) LEFT JOIN b USING (account) WHERE risk > 10""",
)
def _(spark, d):
    return advice.timing_suggestions(timing(spark, d), sem.facts(spark, d), src.accounts(spark, d), AS_OF)


SHARED_SQL["c_revenue"] = f"""
WITH h AS (SELECT account_page, dow, hod, count(*) AS n, avg(price::DOUBLE) AS hist_price, avg(earnings::DOUBLE) AS hist_revenue, stddev_samp(earnings::DOUBLE) AS volatility
    FROM c_dm28 GROUP BY 1, 2, 3 HAVING count(*) >= 2),
alt AS (SELECT account_page, dow, hod, price_q AS alt_price, rps_eb AS alt_revenue FROM c_curve QUALIFY row_number() OVER (PARTITION BY account_page, dow, hod ORDER BY rps_eb DESC, price_q) = 1),
cp AS (SELECT account_page, slot_at, rps_eb AS copy_revenue FROM c_diverse QUALIFY row_number() OVER (PARTITION BY account_page, slot_at ORDER BY score DESC, template) = 1),
j AS (SELECT s.account, s.account_page, s.slot_at, s.price, s.price * coalesce(s.p_buy, 0.08) AS projected, coalesce(h.n, 0) AS n, coalesce(hist_revenue, 0) AS hist_revenue, coalesce(h.volatility, 0) AS volatility,
    coalesce(recommended, 4) AS recommended, v.tier, coalesce(alt_revenue, s.price * coalesce(s.p_buy, 0.08)) AS alt_revenue, coalesce(copy_revenue, s.price * coalesce(s.p_buy, 0.08)) AS copy_revenue, alt_price
  FROM c_slots s LEFT JOIN h ON h.account_page = s.account_page AND h.dow = s.dow AND h.hod = s.hod LEFT JOIN alt ON alt.account_page = s.account_page AND alt.dow = s.dow AND alt.hod = s.hod
  LEFT JOIN c_volume v ON v.account_page = s.account_page LEFT JOIN cp ON cp.account_page = s.account_page AND cp.slot_at = s.slot_at)
SELECT *, round(lift + price_gain * 0.5 + copy_gain * 0.3, 9) AS opportunity FROM (
SELECT *, projected - hist_revenue AS lift, alt_revenue - projected AS price_gain, copy_revenue - projected AS copy_gain, projected * recommended AS day_projection,
  hist_revenue * greatest(recommended, 1) AS day_baseline, CASE WHEN n >= 10 THEN 'HIGH' WHEN n >= 5 THEN 'MEDIUM' WHEN n >= 2 THEN 'LOW' ELSE 'VERY_LOW' END AS confidence,
  CASE WHEN volatility > projected * 0.5 THEN 'HIGH_VOLATILITY' WHEN volatility > projected * 0.3 THEN 'MEDIUM_VOLATILITY' ELSE 'STABLE' END AS risk FROM j)"""


@layer("revenue_projections")
def revenue(spark, d):
    sends = sem.dm(spark, d)
    return advice.revenue_projections(pl.slot_recs(spark, d), sends, semantic.price_curve(sends), volume(spark, d), pl.diverse(spark, d))


@product(
    "revenue_projections", "account_page slot_at:t price:r projected:r hist_revenue:r lift:r price_gain:r copy_gain:r day_projection:r day_baseline:r confidence risk opportunity:r", "SELECT * FROM c_revenue"
)
def _(spark, d):
    return revenue(spark, d)


@product(
    "daily_revenue_impact", "account_page d:d slots:i projected:r baseline:r lift:r price_gain:r copy_gain:r lift_pct:r priority:r advice actions:j",
    f"""SELECT *, CASE WHEN lift > 50 AND sure >= slots * 0.7 THEN 'HIGH_IMPACT' WHEN price_gain + copy_gain > 30 THEN 'OPTIMIZATION' WHEN risky > slots * 0.5 THEN 'CAUTION' WHEN lift > 0 THEN 'POSITIVE' ELSE 'STABLE' END AS advice,
      {ratio('lift', 'baseline')} * 100 AS lift_pct, lift * 0.4 + (price_gain + copy_gain) * 0.3 + ao * slots * 0.2 + CASE tier WHEN 'high' THEN 10 WHEN 'medium' THEN 5 ELSE 3 END * 0.1 AS priority,
      {_present(('price_gain > 20', 'review_pricing'), ('copy_gain > 15', 'improve_copy'), ('risky >= 2', 'watch_volatility'), ('slots < volume', 'add_slots'))} AS actions
    FROM (SELECT account_page, CAST(slot_at AS DATE) AS d, tier, count(*) AS slots, sum(projected) AS projected, sum(day_baseline) AS baseline, sum(day_projection - day_baseline) AS lift,
      sum(greatest(price_gain, 0)) AS price_gain, sum(greatest(copy_gain, 0)) AS copy_gain, max(recommended) AS volume, count(*) FILTER (confidence = 'HIGH') AS sure,
      count(*) FILTER (risk = 'HIGH_VOLATILITY') AS risky, avg(opportunity) AS ao FROM c_revenue GROUP BY 1, 2, 3)""",
)
def _(spark, d):
    return advice.daily_impact(revenue(spark, d))


@product(
    "opportunity_ranking", "account_page slot_at:t raw:r adjusted:r all_rank:i day_rank:i account_rank:i priority",
    """SELECT *, CASE WHEN all_rank <= 10 THEN 'TOP_PRIORITY' WHEN account_rank = 1 THEN 'ACCOUNT_PRIORITY' WHEN price_gain > 20 THEN 'PRICING_FOCUS' WHEN copy_gain > 15 THEN 'COPY_FOCUS'
        WHEN raw > 10 THEN 'GOOD_OPPORTUNITY' ELSE 'STANDARD' END AS priority
      FROM (SELECT *, rank() OVER (ORDER BY adjusted DESC) AS all_rank, rank() OVER (PARTITION BY CAST(slot_at AS DATE) ORDER BY adjusted DESC) AS day_rank,
          row_number() OVER (PARTITION BY account_page ORDER BY adjusted DESC, slot_at) AS account_rank
        FROM (SELECT *, round(raw * CASE confidence WHEN 'HIGH' THEN 1.0 WHEN 'MEDIUM' THEN 0.8 WHEN 'LOW' THEN 0.6 ELSE 0.4 END::DOUBLE * CASE risk WHEN 'HIGH_VOLATILITY' THEN 0.7 WHEN 'MEDIUM_VOLATILITY' THEN 0.85 ELSE 1 END::DOUBLE, 9) AS adjusted
          FROM (SELECT *, lift * 0.4 + price_gain * 0.3 + copy_gain * 0.2 + projected * CASE tier WHEN 'high' THEN 1.2 WHEN 'medium' THEN 1.1 ELSE 1 END::DOUBLE * 0.1 AS raw FROM c_revenue) WHERE raw > 0))""",
)
def _(spark, d):
    return advice.opportunity_ranking(revenue(spark, d))


@product(
    "enhanced_slots", "account_page slot_at:t volume_mult:r timing_mult:r revenue_mult:r impact:r enhanced:r daily_rank:i within_volume priority actions:j alerts:j",
    f"""SELECT *, CASE WHEN daily_rank = 1 THEN 'TOP_PRIORITY' WHEN within_volume AND impact > 0.2 THEN 'HIGH_PRIORITY' WHEN within_volume THEN 'RECOMMENDED' WHEN daily_rank <= 8 THEN 'CONSIDER' ELSE 'LOW_PRIORITY' END AS priority,
      {_present(('timing_risk > 50', 'vary_times'), ('price_gain > 20', 'try_other_price'), ('copy_gain > 15', 'try_other_copy'), ("volume_confidence = 'VERY_LOW'", 'low_volume_confidence'))} AS actions
    FROM (SELECT *, row_number() OVER (PARTITION BY account_page, CAST(slot_at AS DATE) ORDER BY enhanced DESC NULLS LAST, slot_at) AS daily_rank, daily_rank <= coalesce(recommended, 4) AS within_volume
    FROM (SELECT *, volume_mult * timing_mult * revenue_mult - 1 AS impact, round(slot_score * (volume_mult * timing_mult * revenue_mult - 1 + 1), 9) AS enhanced
    FROM (SELECT s.account_page, s.slot_at, s.slot_score, v.recommended, v.confidence AS volume_confidence, t.risk AS timing_risk, price_gain, copy_gain, al.alerts,
      (CASE WHEN v.recommended >= 8 THEN 1.2 WHEN v.recommended >= 6 THEN 1.1 WHEN v.recommended <= 3 THEN 0.9 ELSE 1 END)::DOUBLE AS volume_mult,
      (CASE WHEN common_hour = s.hod AND common_ratio > 0.4 THEN 0.7 WHEN t.risk > 50 AND common_hour = s.hod THEN 0.8 WHEN t.risk < 20 THEN 1.1 ELSE 1 END)::DOUBLE AS timing_mult,
      (CASE WHEN opportunity > 50 THEN 1.3 WHEN opportunity > 25 THEN 1.15 WHEN opportunity > 10 THEN 1.05 WHEN lift < -5 THEN 0.8 ELSE 1 END)::DOUBLE AS revenue_mult
      FROM c_slots s LEFT JOIN c_volume v ON v.account = s.account LEFT JOIN c_timing t ON t.account = s.account LEFT JOIN c_revenue r ON r.account_page = s.account_page AND r.slot_at = s.slot_at
      LEFT JOIN (SELECT account, list(alert ORDER BY rk) AS alerts FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY priority DESC, alert) AS rk FROM c_timing_alerts QUALIFY rk <= 3) GROUP BY 1) al ON al.account = s.account)))""",
)
def _(spark, d):
    t = timing(spark, d)
    return advice.enhanced_slots(pl.slot_recs(spark, d), volume(spark, d), t, advice.timing_alerts(t), revenue(spark, d))


SHARED_SQL["c_enhanced_plan"] = f"""
SELECT *, CASE WHEN round(health, 6) >= 0.9 THEN 'EXCELLENT' WHEN round(health, 6) >= 0.8 THEN 'GOOD' WHEN round(health, 6) >= 0.7 THEN 'FAIR' WHEN round(health, 6) >= 0.6 THEN 'NEEDS_IMPROVEMENT' ELSE 'POOR' END AS grade,
  {_present(("slot_risk = 'HIGH_RISK'", 'change_hour'), ('volume_score < 0.8', 'remove_slot'), ('opportunity > 30', 'optimise_revenue'), ('lift < -5', 'underperforms'))} AS actions
FROM (SELECT *, CASE WHEN slot_rank <= lim THEN 1 ELSE 0.7 END::DOUBLE * 0.4 + timing_score * 0.3 + CASE WHEN opportunity > 25 THEN 1 WHEN opportunity > 10 THEN 0.9 WHEN lift >= 0 THEN 0.8 ELSE 0.6 END::DOUBLE * 0.3 AS health
FROM (SELECT *, (CASE WHEN slot_rank <= lim THEN 1 WHEN slot_rank <= lim + 1 THEN 0.8 ELSE 0.5 END)::DOUBLE AS volume_score,
  (CASE slot_risk WHEN 'LOW_RISK' THEN 1 WHEN 'NORMAL' THEN 0.9 WHEN 'MEDIUM_RISK' THEN 0.7 ELSE 0.4 END)::DOUBLE AS timing_score,
  (CASE WHEN opportunity > 50 THEN 1.2 WHEN opportunity > 25 THEN 1.1 WHEN opportunity > 10 THEN 1 WHEN lift < -5 THEN 0.7 ELSE 0.9 END)::DOUBLE AS revenue_score
FROM (SELECT p.account, p.account_page, p.date_local, p.slot_rank, p.hod, lift, opportunity, coalesce(weekday_volume, v.recommended, 4) AS lim,
  CASE WHEN common_hour = p.hod AND common_ratio > 0.4 THEN 'HIGH_RISK' WHEN t.risk > 50 THEN 'MEDIUM_RISK' WHEN t.risk < 20 THEN 'LOW_RISK' ELSE 'NORMAL' END AS slot_risk
  FROM c_plan p LEFT JOIN c_volume v ON v.account = p.account LEFT JOIN c_weekday_volume w ON w.account = p.account AND w.weekday = dayofweek(p.date_local) + 1
  LEFT JOIN c_timing t ON t.account = p.account LEFT JOIN c_revenue r ON r.account_page = p.account_page AND CAST(r.slot_at AS DATE) = p.date_local AND hour(r.slot_at) = p.hod)))"""


def enhanced_plan(spark, d):
    w = advice.weekday_volume(sem.facts(spark, d), volume(spark, d), AS_OF)
    return advice.enhanced_plan(pl.plan(spark, d), volume(spark, d), w, timing(spark, d), revenue(spark, d))


@product("enhanced_plan", "account_page date_local:d slot_rank:i hod:i slot_risk volume_score:r timing_score:r revenue_score:r health:r grade actions:j", "SELECT * FROM c_enhanced_plan")
def _(spark, d):
    return enhanced_plan(spark, d)


@product(
    "plan_dashboard", "accounts:i health:r volume_issues:i timing_issues:i opportunity:r problem_slots:i slots:i status worst:j",
    """WITH p AS (SELECT account_page, count(*) FILTER (volume_score < 0.8) AS vi, count(*) FILTER (slot_risk IN ('HIGH_RISK', 'MEDIUM_RISK')) AS ti, sum(coalesce(opportunity, 0)) AS o, avg(health) AS h, count(*) AS n,
        count(*) FILTER (round(health, 6) < 0.7) AS ps FROM c_enhanced_plan GROUP BY 1)
      SELECT *, CASE WHEN health < 0.7 THEN 'CRITICAL' WHEN timing_issues > accounts * 0.3 THEN 'TIMING' WHEN volume_issues > accounts * 0.2 THEN 'VOLUME' WHEN opportunity > 1000 THEN 'HIGH_OPPORTUNITY'
        WHEN health > 0.85 THEN 'HEALTHY' ELSE 'MODERATE' END AS status, (SELECT list(account_page ORDER BY round(h, 9), round(o, 6) DESC, account_page)[1:50] FROM p) AS worst
      FROM (SELECT count(*) AS accounts, avg(h) AS health, sum(vi) AS volume_issues, sum(ti) AS timing_issues, sum(o) AS opportunity, sum(ps) AS problem_slots, sum(n) AS slots FROM p)""",
)
def _(spark, d):
    return advice.plan_dashboard(enhanced_plan(spark, d))
