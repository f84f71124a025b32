"""Registered queries: slots, weekly plans, staged rankings, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from outpulse.catalog import ranking as rk
from outpulse.catalog import semantic as sem
from outpulse.catalog.base_sql import ratio
from outpulse.catalog.ranking import hash_int, hash_uniform
from outpulse.catalog.registry import SHARED_SQL, is_stored, layer, product
from outpulse.catalog.semantic import AS_OF, NOW, TODAY
from outpulse.operators.ranking import top_k
from outpulse.plans import rank, semantic, slots
from outpulse.sources import driver_tables as src

SHARED_SQL["c_slots"] = f"""
SELECT account, account_page, slot_at, dow, hod, slot_score, p_buy, rps_lcb, CASE WHEN paid THEN 'paid' ELSE 'free' END AS kind,
  CASE WHEN paid THEN coalesce(price_q, 0) ELSE 0 END AS price
FROM (SELECT g.*, slot_score, p_buy, rps_lcb, price_q, is_paid AND coalesce(rps_lcb >= coalesce(rps_free, 0), false) AS paid
  FROM (SELECT *, (dayofweek(slot_at) + 6) % 7 AS dow, hour(slot_at) AS hod FROM (
      SELECT account, account_page, is_paid, daily_quota, {NOW} + to_hours(CAST(utc_offset + unnest(range(24)) AS BIGINT)) AS slot_at FROM c_accounts)) g
  LEFT JOIN c_scorecard USING (account_page, dow, hod) LEFT JOIN c_best_price USING (account_page, dow, hod)
  QUALIFY row_number() OVER (PARTITION BY account_page, CAST(slot_at AS DATE) ORDER BY slot_score DESC NULLS LAST, slot_at) <= daily_quota)"""


def best_prices(spark, d):
    return semantic.best_prices(semantic.price_curve(sem.dm(spark, d)))


@layer("slot_recommendations")
def slot_recs(spark, d):
    return slots.slot_recommendations(
        src.spread(src.accounts(spark, d), "account"), semantic.slot_scorecard(sem.dm(spark, d)), best_prices(spark, d), AS_OF
    )


@product(
    "slot_recommendations", "account_page slot_at:t dow:i hod:i slot_score:r p_buy:r rps_lcb:r kind price:r", "SELECT * FROM c_slots"
)
def _(spark, d):
    return slot_recs(spark, d)


@product(
    "gated_slots",
    "account_page slot_at:t dow:i hod:i kind price:r",
    """SELECT s.account_page, slot_at, dow, hod, CASE WHEN coalesce(price_q, 0) > 0 THEN 'paid' ELSE 'free' END AS kind, coalesce(price_q, 0) AS price
       FROM c_slots s LEFT JOIN c_best_price USING (account_page, dow, hod) JOIN c_accounts a ON a.account_page = s.account_page
       WHERE is_paid OR coalesce(price_q, 0) <= 0""",
)
def _(spark, d):
    return slots.gated_slots(slot_recs(spark, d), best_prices(spark, d), src.accounts(spark, d))


SHARED_SQL["c_policy"] = """
SELECT account, account_page, assignee, tz, utc_offset, min_hour, max_hour, page_state, dow, daily_quota AS quota, daily_quota * 2 AS hour_pool,
  CASE WHEN dow IN (4, 5) THEN 1 ELSE 0 END AS is_burst FROM c_accounts, range(7) t(dow) WHERE is_active"""


@product("quota_policy", "account dow:i quota:i hour_pool:i is_burst:i tz", "SELECT * FROM c_policy")
def _(spark, d):
    return slots.quota_policy(src.accounts(spark, d))


_DAYS = f"""
SELECT p.*, {hash_int('account', "strftime(date_local, '%Y-%m-%d')")} AS seed, min_hour AS min_h, max_hour AS max_h
FROM (SELECT c_policy.*, CAST({NOW} + to_hours(CAST(utc_offset AS BIGINT)) AS DATE) + CAST(unnest(range(7)) AS INTEGER) AS date_local FROM c_policy) p
WHERE (dayofweek(date_local) + 6) % 7 = dow AND quota > 0"""
_RUN = "OVER (PARTITION BY account, date_local ORDER BY idx ROWS UNBOUNDED PRECEDING)"
SHARED_SQL["c_plan_days"] = _DAYS
SHARED_SQL["c_plan_pool"] = """
SELECT d.account, d.account_page, assignee, tz, utc_offset, page_state, date_local, d.dow, quota, hour_pool, is_burst, min_h, max_h, seed,
  list(h ORDER BY src, s DESC, h) AS c
FROM (SELECT d.*, h, CASE WHEN a.score IS NOT NULL THEN 1 WHEN g.s IS NOT NULL THEN 2 ELSE 3 END AS src, coalesce(a.score, g.s, 0) AS s
  FROM (SELECT *, unnest(range(min_h, max_h + 1)) AS h FROM c_plan_days) d
  LEFT JOIN c_dow_hod a ON a.account = d.account AND a.dow = d.dow AND a.hod = h
  LEFT JOIN (SELECT account, hod, sum(score) AS s FROM c_dow_hod GROUP BY 1, 2) g ON g.account = d.account AND g.hod = h
  WHERE a.score IS NOT NULL OR g.s IS NOT NULL OR h IN (21, 20, 18, 15, 12, 22, 19, 16, 13, 10, 23, 14, 17, 9, 8, 11)) d GROUP BY ALL"""
SHARED_SQL["c_plan_picked"] = """
SELECT * EXCLUDE (rn, cand, off) , cand AS hod0 FROM (
SELECT *, row_number() OVER (PARTITION BY account, date_local, slot_rank ORDER BY abs(cand - anchor), off) AS rn FROM (
SELECT *, CASE WHEN quota = 1 THEN round((a_start + a_end) / 2.0) ELSE a_start + slot_rank * step + (seed + slot_rank) % 3 - 1 END AS anchor,
  unnest(c) AS cand, unnest(range(len(c))) AS off FROM (
SELECT *, unnest(range(least(quota - 1, max_h - min_h) + 1)) AS slot_rank, least(6, greatest(2, round(greatest(a_end - a_start, 2) / greatest(quota - 1, 1)))) AS step
FROM (SELECT *, least(max_h, greatest(min_h, c[1])) AS a_start, greatest(min_h, least(max_h, c[-1])) AS a_end FROM c_plan_pool)))
WHERE off < greatest(hour_pool, least(len(c), quota * 3))) WHERE rn = 1"""
SHARED_SQL["c_plan_spaced"] = f"""
SELECT *, CAST(least(23, greatest(0, least(greatest(low, min_h), cap, max_h - 2 * (n_slots - idx), max_h))) AS BIGINT) AS hod FROM (
SELECT *, 6 * idx + min(low - 6 * idx) {_RUN} AS cap FROM (
SELECT *, greatest(hod0, 2 * idx + max(hod0 - 2 * idx) {_RUN}, min_h + 2 * (idx - 1)) AS low FROM (
SELECT *, row_number() OVER (PARTITION BY account, date_local ORDER BY hod0, slot_rank) AS idx, count(*) OVER (PARTITION BY account, date_local) AS n_slots
FROM c_plan_picked)))"""


def _by_state(grow: str, retain: str, other: str) -> str:
    return f"CASE page_state WHEN 'grow' THEN coalesce({grow}) WHEN 'retain' THEN coalesce({retain}) ELSE coalesce({other}) END"


def _bump(source: str) -> str:
    return (
        "SELECT * REPLACE(price + row_number() OVER (PARTITION BY account, date_local, CAST(round(price) AS BIGINT) ORDER BY slot_rank) - 1 AS price) "
        f"FROM ({source})"
    )


_PRICED = f"""SELECT *, CASE WHEN mode = 'premium' OR is_burst = 1 THEN {_by_state('p60, p50, p35, 6', 'p80, p60, p50, 8', 'p90, p80, p60, 9')}
  WHEN mode = 'value' THEN {_by_state('p35, p50, 5', 'p50, p60, 6', 'p60, p50, 7')}
  ELSE {_by_state('p50, p35, 5', 'p60, p50, 6', 'p80, p60, 8')} END::DOUBLE AS price
FROM (SELECT s.*, p35, p50, p60, p80, p90, CASE WHEN coalesce(weight_price, 1) >= 1.1 THEN 'premium' WHEN coalesce(weight_price, 1) <= 0.95 THEN 'value'
        ELSE coalesce(price_mode, 'balanced') END AS mode FROM c_plan_spaced s LEFT JOIN c_price_profile USING (account) LEFT JOIN c_weights USING (account))"""
SHARED_SQL["c_plan"] = f"""
SELECT *, CAST(date_local AS TIMESTAMP) + to_hours(hod) AS planned_local,
  CAST(date_local AS TIMESTAMP) + to_hours(hod) - to_hours(CAST(utc_offset AS BIGINT)) AS scheduled_utc FROM ({_bump(_bump(_bump(_PRICED)))})"""


def week_of(spark, d, accounts):
    return slots.weekly_plan(
        slots.quota_policy(accounts), semantic.weekday_hour_scores(sem.local(spark, d), AS_OF), semantic.price_profile(sem.local(spark, d)),
        rk.weights(spark, d), AS_OF,
    )


@layer("weekly_plan")
def plan(spark, d):
    return week_of(spark, d, src.spread(src.accounts(spark, d), "account"))


@layer("ranked_week")
def ranked_week(spark, d):
    """The week of the accounts that have copy to rank; each account's week stands alone."""
    ranked = rk.performance(spark, d).select("account").distinct()
    return week_of(spark, d, src.spread(src.accounts(spark, d), "account").join(ranked, "account", "left_semi"))


def plan_to_rank(spark, d):
    """The ranking drops all other accounts, most of them perhaps: unless the whole week is stored they are not planned for it."""
    return plan(spark, d) if is_stored(spark, d, "weekly_plan") else ranked_week(spark, d)


PLAN = "account account_page date_local:d slot_rank:i hod:i price:r planned_local:t scheduled_utc:t"


@product("weekly_plan", PLAN, "SELECT * FROM c_plan")
def _(spark, d):
    return plan(spark, d)


SHARED_SQL["c_plan_pages"] = """
SELECT p.* REPLACE(a.assignee AS assignee), a.page_type,
  base64(unhex(sha256(p.account_page || '|' || strftime(date_local, '%Y-%m-%d') || '|' || hod))) AS tracking_hash
FROM c_plan p JOIN c_accounts a USING (account) WHERE a.is_active"""


@product("plan_pages", "account account_page assignee date_local:d slot_rank:i hod:i price:r tracking_hash", "SELECT * FROM c_plan_pages")
def _(spark, d):
    return slots.plan_pages(plan(spark, d), src.accounts(spark, d))


@product(
    "plan_overrides",
    "account account_page assignee date_local:d slot_rank:i hod:i",
    """SELECT * REPLACE(account || '__' || page_type AS account_page) FROM (
       SELECT p.* REPLACE(CASE WHEN CAST(substr(account, 6) AS BIGINT) % 10 = 3 THEN 'acct_' || (CAST(substr(account, 6) AS BIGINT) - 1) ELSE account END AS account,
         CASE WHEN (CASE WHEN CAST(substr(account, 6) AS BIGINT) % 10 = 3 THEN CAST(substr(account, 6) AS BIGINT) - 1 ELSE CAST(substr(account, 6) AS BIGINT) END) % 4 = 0
              THEN 'lead' ELSE assignee END AS assignee) FROM c_plan_pages p)""",
)
def _(spark, d):
    a = src.accounts(spark, d)
    no = F.substring("account", 6, 20).cast("long")
    aliases = a.where(no % 10 == 3).select("account", F.concat(F.lit("acct_"), no - 1).alias("resolved"))
    overrides = a.where(no % 4 == 0).select("account", F.lit("lead").alias("assignee"))
    return slots.with_overrides(slots.plan_pages(plan(spark, d), a), aliases, overrides)


@product(
    "plan_audit",
    "account date_local:d slot_rank:i hod:i price:r quota:i hour_pool:i weight_price:r weight_volume:r p50:r price_mode dow_score:r",
    """SELECT p.account, p.date_local, p.slot_rank, p.hod, p.price, q.quota, q.hour_pool, w.weight_price, w.weight_volume, pp.p50, pp.price_mode, dow_score
       FROM c_plan p JOIN c_policy q ON q.account = p.account AND q.dow = p.dow LEFT JOIN c_weights w ON w.account = p.account
       LEFT JOIN c_price_profile pp ON pp.account = p.account
       LEFT JOIN (SELECT account, dow, sum(score) AS dow_score FROM c_dow_hod GROUP BY 1, 2) s ON s.account = p.account AND s.dow = p.dow""",
)
def _(spark, d):
    local = sem.local(spark, d)
    return slots.plan_audit(
        plan(spark, d), slots.quota_policy(src.accounts(spark, d)), semantic.weekday_hour_scores(local, AS_OF),
        semantic.price_profile(local), rk.weights(spark, d),
    )


@product(
    "feasibility_alerts",
    "account date_local:d quota:i window_width:i width_needed:i",
    """SELECT DISTINCT account, date_local, quota + 3 AS quota, max_h - min_h AS window_width, 2 * (quota + 2) AS width_needed FROM c_plan
       WHERE max_h - min_h < 2 * (quota + 2)""",
)
def _(spark, d):
    policy = slots.quota_policy(src.accounts(spark, d)).withColumn("quota", F.col("quota") + 3)
    return slots.feasibility_alerts(plan(spark, d), policy)


@product(
    "gap_violations",
    "issue account date_local:d curr_h:i gap_h:i",
    """WITH o AS (SELECT *, lag(hod) OVER w AS prev_h, lead(hod) OVER w AS next_h FROM c_plan WINDOW w AS (PARTITION BY account, date_local ORDER BY hod, slot_rank))
       SELECT 'MIN_GAP_LT_2H' AS issue, account, date_local, hod AS curr_h, hod - prev_h AS gap_h FROM o WHERE hod - prev_h < 2
       UNION ALL SELECT 'MAX_GAP_GT_6H_IN_WINDOW', account, date_local, hod, next_h - hod FROM o WHERE next_h - hod > 6 AND hod BETWEEN min_h AND max_h""",
)
def _(spark, d):
    return slots.gap_violations(plan(spark, d))


@product("plan_summary", "account date_local:d slots:i first_hour:i last_hour:i avg_price:r",
         "SELECT account, date_local, count(*) AS slots, min(hod) AS first_hour, max(hod) AS last_hour, avg(price) AS avg_price FROM c_plan GROUP BY 1, 2")
def _(spark, d):
    return slots.plan_summary(plan(spark, d))


def _jitter(j: int, *key: str) -> str:
    return f"({hash_int(*key)} % {2 * j + 1} - {j})"


_DS = "strftime(d, '%Y-%m-%d')"
SHARED_SQL["c_windows"] = f"""
WITH days AS (SELECT account, utc_offset, renew_on_pct, CAST({NOW} + to_hours(CAST(utc_offset AS BIGINT)) AS DATE) + CAST(unnest(range(7)) AS INTEGER) AS d FROM c_accounts WHERE is_active),
u AS (
  SELECT account, utc_offset, CASE WHEN ch = 'MM' THEN 'drip_mm' ELSE 'drip_wall' END AS kind,
    CAST(d AS TIMESTAMP) + CAST(hhmm AS TIME)::VARCHAR::INTERVAL + to_minutes({_jitter(45, 'account', _DS, "'DRIP'", 'hhmm', 'ch')}) AS planned_local
  FROM days, (VALUES ('10:30', 'MM'), ('14:00', 'Wall'), ('19:15', 'MM')) t(hhmm, ch)
  UNION ALL SELECT account, utc_offset, 'renewal', CAST(d AS TIMESTAMP) + CAST(hhmm AS TIME)::VARCHAR::INTERVAL + to_minutes({_jitter(45, 'account', _DS, "'RENEW'", 'hhmm')})
  FROM days, (VALUES ('11:00'), ('20:00')) t(hhmm) WHERE renew_on_pct > 0
  UNION ALL SELECT account, utc_offset, 'link_drop', s + to_minutes({hash_int('account', "strftime(s, '%Y-%m-%d %H:%M')", "'link'")} % greatest(width, 1))
  FROM (SELECT account, utc_offset, CAST(d AS TIMESTAMP) + CAST(hhmm AS TIME)::VARCHAR::INTERVAL AS s, width FROM days, (VALUES ('12:00', 120), ('17:30', 90)) t(hhmm, width)))
SELECT account, kind, CAST(planned_local AS DATE) AS date_local, hour(planned_local) AS hod, planned_local, planned_local - to_hours(CAST(utc_offset AS BIGINT)) AS scheduled_utc FROM u"""


@product("side_windows", "account kind date_local:d hod:i planned_local:t scheduled_utc:t", "SELECT * FROM c_windows")
def _(spark, d):
    return slots.side_windows(src.spread(src.accounts(spark, d), "account"), AS_OF)


_KEY = ("account", "strftime(date_local, '%Y-%m-%d')", "slot_rank", "step")
SHARED_SQL["c_bumps"] = f"""
SELECT account, date_local, slot_rank, level, step, CASE WHEN step = 0 THEN 'pre_teaser' ELSE 'followup' END AS activity,
  planned_local + to_minutes(low + {hash_int(*_KEY)} % (high - low + 1) + {_jitter(45, *_KEY, "'J'")}) AS planned_local,
  scheduled_utc + to_minutes(low + {hash_int(*_KEY)} % (high - low + 1) + {_jitter(45, *_KEY, "'J'")}) AS scheduled_utc
FROM (SELECT *, CASE WHEN price >= coalesce(p90, price) THEN 'premium' WHEN price >= coalesce(p50, price) THEN 'mid' ELSE 'teaser' END AS level FROM (SELECT account, date_local, slot_rank, price, planned_local, scheduled_utc FROM c_plan) LEFT JOIN c_price_profile USING (account) WHERE price > 0)
JOIN (VALUES ('teaser', 1, 20, 45), ('mid', 0, -20, -15), ('mid', 1, 15, 20), ('mid', 2, 45, 45), ('premium', 0, -20, -15), ('premium', 1, 20, 30), ('premium', 2, 40, 55))
  r(level, step, low, high) USING (level)"""


def bumps(spark, d, p):
    return slots.followup_bumps(p, semantic.price_profile(sem.local(spark, d)))


@product("followup_bumps", "account date_local:d slot_rank:i level step:i activity planned_local:t scheduled_utc:t", "SELECT * FROM c_bumps")
def _(spark, d):
    return bumps(spark, d, plan(spark, d))


@product(
    "my_day",
    "account_page kind channel planned_local:t hod:i price:r shown_as",
    f"""SELECT a.account_page, kind, CASE WHEN kind IN ('drip_wall', 'link_drop') THEN 'Wall' ELSE 'MM' END AS channel, planned_local, hour(planned_local) AS hod, price,
         strftime(planned_local, '%a %b %d, %I:%M %p') AS shown_as
       FROM (SELECT account, 'paid' AS kind, planned_local, price FROM c_plan UNION ALL SELECT account, 'followup', planned_local, NULL FROM c_bumps
             UNION ALL SELECT account, kind, planned_local, NULL FROM c_windows) JOIN c_accounts a USING (account)
       WHERE CAST(planned_local AS DATE) = CAST({NOW} + to_hours(CAST(utc_offset AS BIGINT)) AS DATE)""",
)
def _(spark, d):
    a, p = src.accounts(spark, d), plan(spark, d)
    return slots.my_day(p, bumps(spark, d, p), slots.side_windows(a, AS_OF), a, AS_OF)


SHARED_SQL["c_brief"] = f"""
WITH h AS (SELECT account, (list(hod ORDER BY s DESC, hod))[1:5] AS best_hours FROM (SELECT account, hod,
    sum(earnings::DOUBLE * exp(-trunc(epoch({NOW} - local_at) / 86400) / 60.0)) AS s FROM c_local GROUP BY 1, 2) GROUP BY 1),
b AS (SELECT account, quantile_disc(price::DOUBLE, 0.4) AS p25, quantile_disc(price::DOUBLE, 0.5) AS p50, quantile_disc(price::DOUBLE, 0.7) AS p75
      FROM c_facts WHERE sent_at < {NOW} GROUP BY 1),
c AS (SELECT k.account, k.template, category, coalesce(revenue, 0) AS revenue, last_date
      FROM (SELECT owned_by AS account, template FROM c_templates UNION SELECT account, template FROM c_facts) k JOIN c_templates t ON t.template = k.template
      LEFT JOIN (SELECT account, template, CAST(sum(earnings) AS DOUBLE) AS revenue, max(sent_date) AS last_date FROM c_facts
        WHERE sent_at < {NOW} GROUP BY 1, 2) f ON f.account = k.account AND f.template = k.template),
s AS (SELECT account, list(template ORDER BY rank) AS suggestions FROM (SELECT *, row_number() OVER (PARTITION BY account
      ORDER BY coalesce({TODAY} - last_date >= 28, true) DESC, revenue DESC, template) AS rank FROM c QUALIFY rank <= 10) GROUP BY 1),
v AS (SELECT account, count(DISTINCT template) AS avoid_count, list(DISTINCT template ORDER BY template) AS avoid FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 7 DAY AND sent_at < {NOW} GROUP BY 1)
SELECT account, assignee, page_state, coalesce(best_hours, []) AS best_hours, p25, p50, p75, suggestions, coalesce(avoid_count, 0) AS avoid_count, coalesce(avoid, []) AS avoid
FROM c_accounts LEFT JOIN h USING (account) LEFT JOIN b USING (account) LEFT JOIN s USING (account) LEFT JOIN v USING (account)"""


def brief(spark, d):
    return slots.daily_brief(src.accounts(spark, d), sem.local(spark, d), sem.facts(spark, d), src.templates(spark, d), AS_OF)


@product("daily_brief", "account assignee page_state best_hours:j p25:r p50:r p75:r suggestions:j avoid_count:i avoid:j", "SELECT * FROM c_brief")
def _(spark, d):
    return brief(spark, d).select("*", "price_band.*", F.transform("suggestions", lambda s: s.template).alias("t")).drop("suggestions").withColumnRenamed("t", "suggestions")


@product(
    "brief_rows",
    "assignee account p25:r p50:r hod1:i template suggestion_rank:i",
    """SELECT assignee, account, p25, p50, best_hours[1] AS hod1, unnest(suggestions) AS template, unnest(range(1, len(suggestions) + 1)) AS suggestion_rank
       FROM c_brief WHERE assignee = 'S3' AND suggestions IS NOT NULL
       UNION ALL SELECT assignee, account, p25, p50, best_hours[1], NULL, 0 FROM c_brief WHERE assignee = 'S3' AND suggestions IS NULL""",
)
def _(spark, d):
    users = src.accounts(spark, d).groupBy("assignee").agg(F.lit(False).alias("can_view_all")).withColumn("email", F.concat("assignee", F.lit("@example.com")))
    return slots.brief_rows(brief(spark, d), users, "s3@example.com").fillna(0, ["suggestion_rank"])


SHARED_SQL["c_tier_top"] = f"""
SELECT d.*, hour, lift, rank_in_day, min(CASE WHEN rank_in_day = 1 THEN hour END) OVER (PARTITION BY account, slot_date) AS a1
FROM (SELECT account, tier, anchors, supports, spacing, jit, CAST(DATE '2024-02-05' + CAST(unnest(range(7)) AS INTEGER) AS DATE) AS slot_date FROM c_intensity
      JOIN (VALUES ('high', 2, 4, 90, 30), ('medium', 2, 3, 120, 30), ('low', 1, 2, 180, 20)) t(tier, anchors, supports, spacing, jit) USING (tier)) d
JOIN c_hour_profile p USING (account) WHERE p.weekday = dayofweek(slot_date) + 1"""


def _minute(tag: str) -> str:
    u = hash_uniform("account", "strftime(slot_date, '%Y-%m-%d')", "hour", f"'{tag}'")
    return f"CAST(hour * 60 + floor({u} * jit) AS BIGINT)"


SHARED_SQL["c_tier_slots"] = f"""
WITH a2 AS (SELECT account, slot_date, min((rank_in_day, hour)) AS a2 FROM c_tier_top
    WHERE anchors >= 2 AND rank_in_day > 1 AND least(abs(hour - a1), 24 - abs(hour - a1)) >= 4 GROUP BY 1, 2),
k AS (SELECT t.*, CASE WHEN hour = a1 OR coalesce(hour = a2[2], false) THEN 'ANCHOR' WHEN rank_in_day > anchors THEN 'SUPPORT' END AS kind,
    CASE WHEN hour = a1 THEN {_minute('a1')} WHEN coalesce(hour = a2[2], false) THEN {_minute('a2')} ELSE {_minute('sup')} END AS minute
  FROM c_tier_top t LEFT JOIN a2 USING (account, slot_date)),
r AS (SELECT *, row_number() OVER (PARTITION BY account, slot_date, kind ORDER BY lift DESC, hour) AS kr FROM k WHERE kind IS NOT NULL)
SELECT account, slot_date, kind, hour, minute, lift FROM r WHERE kind = 'ANCHOR' OR (kr <= supports AND NOT EXISTS (
  SELECT 1 FROM k a WHERE a.kind = 'ANCHOR' AND a.account = r.account AND a.slot_date = r.slot_date
    AND least(abs(r.minute - a.minute), 1440 - abs(r.minute - a.minute)) < r.spacing))"""


@product(
    "tier_plan",
    "account slot_date:d kind hour:i minute:i lift:r templates:j",
    """SELECT s.*, templates FROM c_tier_slots s LEFT JOIN (SELECT account, list(template ORDER BY rank) AS templates FROM (
         SELECT r.*, account FROM o_rank_templates_ucb r JOIN c_accounts USING (account_page)) WHERE rank <= 3 GROUP BY 1) USING (account)""",
)
def _(spark, d):
    f = sem.facts(spark, d)
    cands = rank.rank_templates(rk.ready(spark, d), AS_OF, 3, "ucb").join(src.accounts(spark, d).select("account", "account_page"), "account_page")
    return slots.tier_plan(semantic.intensity(f, AS_OF), semantic.hour_profile(f, AS_OF), cands, "2024-02-05")


SHARED_SQL["c_prelim"] = f"""
WITH cand AS (SELECT account_page, template, length_bin, emoji_bin, has_cta, has_urgency, ends_with_question, last_used_at, cooldown_ok FROM c_pool
    WHERE account_page IN (SELECT account_page FROM c_slots)
  UNION ALL SELECT DISTINCT account_page, account_page || '|fallback', 'short', 'none', false, false, false, NULL, true FROM c_slots
    WHERE account_page NOT IN (SELECT account_page FROM c_pool)),
x AS (SELECT s.account_page, s.slot_at, s.dow, s.hod, greatest(s.price, 0) AS price, c.* EXCLUDE (account_page), coalesce(decayed_sent, 0) AS n,
    (coalesce(decayed_bought, 0) + 200 * coalesce(mu_buy, 0.08)) / (coalesce(decayed_sent, 0) + 200) AS p_buy, 0.1 * coalesce(lift_clamped, 0) AS style_score,
    0.15 + 0.45 * (0.5 / (1 + log10(1 + coalesce(sent_28d, 0))) + 0.5 / (1 + log10(1 + coalesce(vol, 0)))) AS sigma,
    sum(CASE WHEN cooldown_ok THEN 1 ELSE 0 END) OVER (PARTITION BY s.account_page, s.slot_at) AS ok_count,
    coalesce((epoch_us({NOW}) - epoch_us(last_used_at)) // 86400000000, 999999) AS idle
  FROM c_slots s JOIN cand c USING (account_page) LEFT JOIN c_decayed st ON st.account_page = s.account_page AND st.template = c.template
  LEFT JOIN c_priors p ON p.account_page = s.account_page
  LEFT JOIN (SELECT account_page, dow, hod, sum(sent) AS sent_28d FROM c_dm28 GROUP BY 1, 2, 3) v ON v.account_page = s.account_page AND v.dow = s.dow AND v.hod = s.hod
  LEFT JOIN (SELECT account_page, sum(decayed_sent) AS vol FROM c_decayed GROUP BY 1) pv ON pv.account_page = s.account_page
  LEFT JOIN c_style sl ON sl.account_page = s.account_page AND sl.dow = s.dow AND sl.hod = s.hod AND sl.length_bin = c.length_bin AND sl.emoji_bin = c.emoji_bin
    AND sl.has_cta = c.has_cta AND sl.has_urgency = c.has_urgency AND sl.ends_with_question = c.ends_with_question)
SELECT *, round(rps_eb + bonus + style_score + CASE WHEN cooldown_ok OR ok_count > 0 THEN 0 ELSE -0.000001 * idle END, 9) AS preliminary FROM (
SELECT *, round(price * p_buy, 9) AS rps_eb, least(CASE WHEN price > 0 THEN sigma * price * sqrt(greatest(p_buy * (1 - p_buy), 0) / greatest(n + 200, 1)) ELSE 0 END, 2 * price * p_buy) AS bonus FROM x)"""


@layer("preliminary_ranking")
def preliminary(spark, d):
    sends = sem.dm(spark, d)
    return rank.preliminary_scores(
        slot_recs(spark, d), sem.pool(spark, d), semantic.style_lift(sends, sem.used_features(spark, d), AS_OF),
        semantic.decayed_template_stats(sends, AS_OF), semantic.account_priors(sends), sends, AS_OF,
    )


@product("preliminary_ranking", "account_page slot_at:t template price:r p_buy:r rps_eb:r bonus:r style_score:r cooldown_ok preliminary:r", "SELECT * FROM c_prelim")
def _(spark, d):
    return preliminary(spark, d)


SHARED_SQL["c_flags"] = """
WITH t AS (SELECT account_page, slot_at, template FROM c_prelim QUALIFY row_number() OVER (PARTITION BY account_page, slot_at ORDER BY preliminary DESC, template) = 1)
SELECT *, row_number() OVER (PARTITION BY account_page, CAST(slot_at AS DATE), template ORDER BY preliminary DESC, slot_at) AS same_day_rank,
  EXISTS (SELECT 1 FROM t WHERE t.template = p.template AND t.account_page <> p.account_page AND abs(date_diff('hour', t.slot_at, p.slot_at)) <= 6) AS conflict
FROM c_prelim p"""
SHARED_SQL["c_diverse"] = """
SELECT *, preliminary - CASE WHEN same_day_rank > 1 THEN greatest(rps_eb, 0.0005) ELSE 0 END - CASE WHEN conflict THEN 0.75 * greatest(rps_eb, 0.0005) ELSE 0 END AS score FROM c_flags"""


@layer("diverse_ranking")
def diverse(spark, d):
    # What its readers need; the rest of a candidate's slot row is neither shuffled nor stored again.
    ranked = rank.diverse_ranking(preliminary(spark, d), stable=True)
    return ranked.select("account_page", "slot_at", "template", "rps_eb", "same_day_rank", "conflict", "score")


@product(
    "diverse_ranking",
    "account_page slot_at:t template same_day_rank:i conflict score:r rank:i",
    "SELECT *, row_number() OVER (PARTITION BY account_page, slot_at ORDER BY score DESC, template) AS rank FROM c_diverse QUALIFY rank <= 20",
)
def _(spark, d):
    return top_k(diverse(spark, d), ["account_page", "slot_at"], [F.col("score").desc(), F.col("template")], 20)


@product(
    "diverse_ranking_ban",
    "account_page slot_at:t template score:r rank:i",
    """SELECT *, preliminary AS score, row_number() OVER (PARTITION BY account_page, slot_at ORDER BY preliminary DESC, template) AS rank FROM c_flags
       WHERE same_day_rank = 1 AND NOT conflict QUALIFY rank <= 20""",
)
def _(spark, d):
    return rank.diverse_ranking(preliminary(spark, d), rank.DiversityParams(ban=True), keep=20, stable=True)


SHARED_SQL["c_cooldowns"] = f"""
WITH k AS (SELECT d.*, account FROM c_diverse d JOIN c_accounts USING (account_page)),
q AS (SELECT quantile_disc(rps_eb, 0.75) AS rps75, quantile_disc(rps_eb, 0.9) AS rps90, quantile_disc(score, 0.75) AS score75 FROM k),
h AS (SELECT template, slot_at, avg(hour_score) OVER (PARTITION BY template ORDER BY slot_at ROWS 7 PRECEDING) AS rolling
      FROM (SELECT template, slot_at, avg(score) AS hour_score FROM k GROUP BY 1, 2)),
b AS (SELECT k.account, account_page, template, max(rps_eb) AS rps, max(slot_at) AS slot_at FROM k GROUP BY 1, 2, 3),
x AS (SELECT b.*, rolling, coalesce(fatigue, 0) AS fatigue, last_used_at, accounts_using, coalesce(engagement, 0.5) AS engagement, coalesce(volume_tier, 'MINIMAL_VOLUME') AS volume_tier, q.*,
  CASE WHEN rps > rps90 THEN 2 WHEN rps > rps75 THEN 3 WHEN content_level = 'explicit' THEN 10 WHEN content_level = 'moderate' THEN 7 ELSE 5 END AS base_days
  FROM b JOIN h USING (template, slot_at) JOIN (SELECT template, count(DISTINCT account_page) AS accounts_using FROM k GROUP BY 1) u USING (template)
  LEFT JOIN (SELECT template, content_level FROM c_features) USING (template) LEFT JOIN (SELECT template, engagement FROM c_engagement) USING (template)
  LEFT JOIN (SELECT account, template, fatigue FROM c_fatigue) f USING (account, template) LEFT JOIN c_last_used l USING (account, template)
  LEFT JOIN c_patterns p USING (account), q),
y AS (SELECT *, round(base_days::DOUBLE * CASE WHEN fatigue >= 0.8 THEN 1.8 WHEN fatigue >= 0.5 THEN 1.4 WHEN fatigue >= 0.3 THEN 1.2 ELSE 1 END::DOUBLE
    * CASE WHEN accounts_using > 5 THEN 1.5 WHEN accounts_using > 3 THEN 1.3 WHEN accounts_using > 1 THEN 1.1 ELSE 1 END::DOUBLE
    * CASE volume_tier WHEN 'HIGH_VOLUME' THEN 0.8 WHEN 'MEDIUM_VOLUME' THEN 0.9 WHEN 'LOW_VOLUME' THEN 1 ELSE 1.2 END::DOUBLE) AS rest FROM x)
SELECT *, greatest(rest, 1) AS cooldown_days, coalesce(last_used_at + to_days(CAST(rest AS INTEGER)), {NOW}) AS available_after,
  rolling > score75 AND fatigue < 0.3 AND engagement > 0.6 AS override_suggested, rolling > score75 AND rps > rps75 AND fatigue < 0.5 AS emergency_override,
  CASE WHEN rps > rps90 THEN 'ELITE' WHEN rps > rps75 THEN 'HIGH_PERFORMER' WHEN rps > 0 THEN 'AVERAGE' ELSE 'UNTESTED' END AS performance_tier FROM y"""


def ranked_copy(spark, d):
    """The copy that is ranked for a slot, sent before or not."""
    return src.templates(spark, d).join(diverse(spark, d).select("template").distinct(), "template", "left_semi")


@layer("smart_cooldowns")
def cooldowns(spark, d):
    f, t = sem.facts(spark, d), ranked_copy(spark, d)
    return rank.smart_cooldowns(
        diverse(spark, d), semantic.template_features(t), semantic.fatigue_scores(f, AS_OF), semantic.last_used(f, AS_OF),
        semantic.engagement_scores(t), semantic.engagement_patterns(f, AS_OF), src.accounts(spark, d), AS_OF,
    )


@product(
    "smart_cooldowns",
    "account template fatigue:r base_days:i accounts_using:i rolling:r volume_tier cooldown_days:i available_after:t override_suggested emergency_override performance_tier",
    "SELECT * REPLACE(CASE WHEN template LIKE '%fallback' THEN 5 ELSE base_days END AS base_days) FROM c_cooldowns",
)
def _(spark, d):
    return cooldowns(spark, d)


@product(
    "template_availability", "account template available_after:t is_available",
    f"SELECT account, template, available_after, available_after <= {NOW} AS is_available FROM c_cooldowns",
)
def _(spark, d):
    return rank.availability(cooldowns(spark, d), AS_OF)


@product(
    "cooldown_report", "performance_tier templates:i avg_days:r min_days:i max_days:i overrides:i emergencies:i",
    """SELECT performance_tier, count(*) AS templates, avg(cooldown_days) AS avg_days, min(cooldown_days) AS min_days, max(cooldown_days) AS max_days,
       count(*) FILTER (override_suggested) AS overrides, count(*) FILTER (emergency_override) AS emergencies FROM c_cooldowns GROUP BY 1""",
)
def _(spark, d):
    return rank.cooldown_report(cooldowns(spark, d))


_ST = {s: rank.STATE_WEIGHTS[v] for s, v in rank.MODE_STATE.items()}


def _w(name: str) -> str:
    return "CASE page_state " + " ".join(f"WHEN '{s}' THEN {w[name]}" for s, w in _ST.items()) + " END"


SHARED_SQL["c_weighted_all"] = f"""
WITH u AS (SELECT account, template, max(sent_at) AS last_sent, count(*) FILTER (wk) AS uses_7d, count(DISTINCT sent_date) FILTER (wk) AS days_7d
      FROM (SELECT *, sent_at >= {NOW} - INTERVAL 7 DAY AND sent_at < {NOW} AS wk FROM c_facts) GROUP BY 1, 2),
m AS (SELECT account, {ratio('sum(earnings) FILTER (wk) / nullif(sum(sent) FILTER (wk), 0)', 'sum(earnings)::DOUBLE / sum(sent)')} AS momentum
      FROM (SELECT *, sent_at >= {NOW} - INTERVAL 7 DAY AS wk FROM c_facts WHERE sent > 0 AND sent_at >= {NOW} - INTERVAL 30 DAY AND sent_at < {NOW}) GROUP BY 1),
e AS (SELECT account, max_by(band, (r, band)) AS best_band, max(r) AS best_band_rps FROM (SELECT account, CASE WHEN price < 15 THEN 'low' WHEN price < 30 THEN 'mid'
      WHEN price < 45 THEN 'high' ELSE 'premium' END AS band, avg(earnings::DOUBLE / sent) AS r FROM c_facts WHERE sent > 0 AND sent_at < {NOW} GROUP BY 1, 2) GROUP BY 1),
t AS (SELECT *, percent_rank() OVER (PARTITION BY account ORDER BY score) AS timing_pct FROM c_dow_hod),
x AS (SELECT pf.*, p.date_local, p.hod, p.dow, p.slot_rank, a.page_type, page_state, timing_pct, momentum, best_band, best_band_rps, uses_7d, days_7d, last_sent, c.category,
    {hash_uniform('template', "strftime(p.date_local, '%Y%m%d')", 'p.hod')} < {_w('epsilon')} AS explore
  FROM (SELECT account, date_local, hod, dow, slot_rank FROM c_plan) p JOIN c_perf pf USING (account) JOIN c_accounts a USING (account) JOIN c_templates c USING (template) LEFT JOIN u USING (account, template)
  LEFT JOIN m USING (account) LEFT JOIN e USING (account) LEFT JOIN t ON t.account = p.account AND t.dow = p.dow AND t.hod = p.hod)
SELECT *, {_w('rps')} * rps_z + {_w('open')} * open_rate_z + {_w('buy')} * conversion_z + {_w('timing')} * (coalesce(timing_pct, 0.5) - 0.5) * 2
    + {_w('price')} * CASE WHEN best_band = 'mid' AND rps > best_band_rps THEN 0.2 WHEN best_band = 'high' AND rps > best_band_rps THEN 0.1 ELSE 0 END
    + {_w('novelty')} * novelty + {_w('momentum')} * least(1.5, greatest(0.5, coalesce(momentum, 1)))
    + CASE WHEN cold_start THEN {_w('ucb_c')} * exploration WHEN explore THEN 2 ELSE 0 END AS score,
  NOT coalesce(uses_7d >= 3 OR days_7d >= 3 OR (epoch_us({NOW}) - epoch_us(last_sent)) // 3600000000 < 6, false) AS cooldown_ok, NOT coalesce(uses_7d > 0, false) AS dedupe_ok,
  CASE WHEN cold_start THEN 'cold_start_exploration' WHEN explore THEN 'epsilon_exploration' WHEN rps_pct > 0.8 THEN 'high_performer'
       WHEN timing_pct > 0.7 THEN 'optimal_timing' WHEN novelty > 0.9 THEN 'fresh_content' ELSE 'balanced_selection' END AS reason FROM x"""
SHARED_SQL["c_weighted"] = """
SELECT w.*, categories, 100 * (score - lo) / nullif(hi - lo, 0) AS score_100 FROM (SELECT *, row_number() OVER (PARTITION BY account, date_local, hod, slot_rank
    ORDER BY CASE WHEN cooldown_ok AND dedupe_ok THEN 0 ELSE 1 END, score DESC, days_since_used DESC, template) AS rank FROM c_weighted_all QUALIFY rank <= 20) w
JOIN (SELECT account, date_local, hod, slot_rank, min(score) AS lo, max(score) AS hi, count(DISTINCT category) AS categories FROM c_weighted_all GROUP BY 1, 2, 3, 4) USING (account, date_local, hod, slot_rank)"""


def ranked_by_weights(spark, d, settings=None):
    return rank.weighted_ranking(
        plan_to_rank(spark, d), rk.performance(spark, d), sem.facts(spark, d), src.accounts(spark, d),
        semantic.weekday_hour_scores(sem.local(spark, d), AS_OF), src.templates(spark, d), AS_OF, settings=settings,
    )


def weighted(spark, d):
    return ranked_by_weights(spark, d)


@product(
    "weighted_ranking",
    "account template date_local:d hod:i slot_rank:i rank:i score:r score_100:r cooldown_ok dedupe_ok reason categories:i",
    "SELECT * FROM c_weighted",
)
def _(spark, d):
    return weighted(spark, d)


# Settings for one state only, an old row and a live one with two weights; all else takes the defaults.
_TUNED = {"rps": 0.40, "epsilon": 0.20}
_tuned_all = SHARED_SQL["c_weighted_all"]
for _name, _value in _TUNED.items():
    _tuned_all = _tuned_all.replace(_w(_name), f"CASE page_state WHEN 'grow' THEN {_value} ELSE {_w(_name)} END")
SHARED_SQL["c_tuned_all"] = _tuned_all


@product(
    "tuned_ranking",
    "account template date_local:d hod:i slot_rank:i rank:i score:r score_100:r cooldown_ok dedupe_ok reason categories:i",
    SHARED_SQL["c_weighted"].replace("c_weighted_all", "c_tuned_all"),
)
def _(spark, d):
    rows = [("grow", 0.01, None, "2024-01-01 00:00:00"), ("grow", _TUNED["rps"], _TUNED["epsilon"], "2024-01-20 00:00:00")]
    return ranked_by_weights(spark, d, spark.createDataFrame(rows, "page_state string, rps double, epsilon double, updated_at string"))


_PB = "CASE tier || w.page_type " + " ".join(f"WHEN '{t}{p}' THEN {{{i}}}" for i, (t, p) in enumerate(slots.PRICE_BANDS)) + " END"


def _band(which: int) -> str:
    out = _PB
    for i, v in enumerate(slots.PRICE_BANDS.values()):
        out = out.replace(f"{{{i}}}", str(v[which]))
    return out


@product(
    "schedule_export",
    "account date_local:d day_name slot send_time price:r ladder_position:i template preview score:r reason slot_note details",
    f"""SELECT *, round(price0 + [-1, 0, 1, 2, -2][ladder_position] * step, 2) AS price FROM (SELECT w.account, w.page_type, date_local, hod, slot_rank, strftime(date_local, '%a') AS day_name, 'Slot ' || (slot_rank + 1) AS slot,
        strftime(CAST(date_local AS TIMESTAMP) + to_hours(hod) + to_minutes({_jitter(10, 'a.account_page', "strftime(date_local, '%Y%m%d')", 'hod')}), '%H:%M') AS send_time,
        CASE WHEN NOT blocked AND cooldown_ok AND dedupe_ok THEN template ELSE CASE w.page_type WHEN 'main' THEN 'FALLBACK_001' WHEN 'vip' THEN 'FALLBACK_002' WHEN 'free' THEN 'FALLBACK_003' END END AS template,
        substr(body, 1, 100) AS preview, round(coalesce(score_100, 0)) AS score,
        CASE WHEN blocked THEN 'compliance_filtered' WHEN NOT cooldown_ok THEN 'cooldown_override' WHEN NOT dedupe_ok THEN 'dedup_override' ELSE reason END AS reason,
        CASE WHEN slot_rank = 0 THEN 'Prime slot' WHEN slot_rank = 1 THEN 'Secondary peak' ELSE 'Coverage slot' END AS slot_note,
        '{{' || concat_ws(',', '"category":"' || w.category || '"', '"cooldown_ok":' || cooldown_ok, '"dedupe_ok":' || dedupe_ok, '"cold_start":' || cold_start, '"days_since_used":' || days_since_used) || '}}' AS details,
        coalesce({_band(0)}, CASE w.page_type WHEN 'main' THEN 9.99 WHEN 'vip' THEN 14.99 END, 19.99)::DOUBLE AS price0, coalesce({_band(1)}, 1.0)::DOUBLE AS step, unnest(range(1, 6)) AS ladder_position
      FROM (SELECT * FROM c_weighted WHERE rank = 1) w JOIN (SELECT *, regexp_matches(lower(body), 'worthless|pathetic') AS blocked FROM c_templates) t USING (template)
      JOIN c_accounts a USING (account))""",
)
def _(spark, d):
    return export(spark, d)


def export(spark, d):
    return slots.schedule_export(weighted(spark, d), src.templates(spark, d), src.accounts(spark, d), ("worthless", "pathetic"))


SHARED_SQL["c_scheduled"] = """
SELECT 'sch' || event_no AS schedule_id, account, sender AS assignee, sent_at - to_hours(CAST(event_no % 36 AS BIGINT)) AS logged_at, price,
  CASE WHEN event_no % 9 = 0 THEN template END AS tracking, CASE WHEN event_no % 3 = 0 THEN template END AS template
FROM (SELECT *, CAST(substr(message_id, 2) AS BIGINT) AS event_no FROM c_facts)"""
_S = f"(SELECT account, template, price, message_id, sent_at, earnings FROM c_facts WHERE sent_at >= {NOW} - INTERVAL 180 DAY AND sent_at < {NOW})"


@product(
    "send_links",
    "schedule_id account logged_at:t matched_by message_id sent_at:t earnings:r",
    f"""SELECT * FROM (
      SELECT s.schedule_id, s.account, s.logged_at, 'hash' AS matched_by, 3 AS sc, m.message_id, m.sent_at, m.earnings FROM c_scheduled s JOIN {_S} m ON m.account = s.account AND m.template = s.tracking
      UNION ALL SELECT s.schedule_id, s.account, s.logged_at, 'template', 2, m.message_id, m.sent_at, m.earnings FROM c_scheduled s JOIN {_S} m ON m.account = s.account AND m.template = s.template
      UNION ALL SELECT s.schedule_id, s.account, s.logged_at, 'time_price', 1, m.message_id, m.sent_at, m.earnings FROM c_scheduled s JOIN {_S} m ON m.account = s.account AND m.price = s.price
        AND m.sent_at BETWEEN s.logged_at - INTERVAL 1 DAY AND s.logged_at + INTERVAL 14 DAY)
      QUALIFY row_number() OVER (PARTITION BY schedule_id ORDER BY sc DESC, abs(epoch_us(sent_at) - epoch_us(logged_at)), sent_at, message_id) = 1""",
)
def _(spark, d):
    f = sem.facts(spark, d).withColumn("n", F.substring("message_id", 2, 20).cast("long"))
    scheduled = f.select(
        F.concat(F.lit("sch"), "n").alias("schedule_id"), "account", F.col("sender").alias("assignee"),
        (F.col("sent_at") - F.make_dt_interval(hours=(F.col("n") % 36).cast("int"))).alias("logged_at"), "price",
        F.when(F.col("n") % 9 == 0, F.col("template")).alias("tracking"), F.when(F.col("n") % 3 == 0, F.col("template")).alias("template"),
    )
    return slots.send_links(scheduled, sem.facts(spark, d), AS_OF)
