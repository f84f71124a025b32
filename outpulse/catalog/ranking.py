"""Registered queries: feature store, bandit policies and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from outpulse.catalog import semantic as sem
from outpulse.catalog.base_sql import ratio
from outpulse.catalog.registry import SHARED_SQL, layer, product
from outpulse.catalog.semantic import AS_OF, NOW, TODAY
from outpulse.plans import features, rank, semantic, slots
from outpulse.sources import driver_tables as src


def hash_int(*parts: str) -> str:
    joined = " || ':' || ".join(f"({p})" for p in parts)
    return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"


def hash_uniform(*parts: str) -> str:
    return f"({hash_int(*parts)} / 1152921504606846976.0::DOUBLE)"


@layer("feature_store")
def store(spark, d):
    return features.feature_store(sem.daily(spark, d), sem.facts(spark, d), AS_OF)


SHARED_SQL["c_store_base"] = f"""
WITH recent AS (SELECT *, 0.5 ** (({TODAY} - metric_date) / 14.0) AS w FROM c_daily WHERE metric_date BETWEEN {TODAY} - 30 AND {TODAY}),
b AS (SELECT account, template, account_page, category, sum(revenue) / sum(sent) AS rps_30d, sum(purchased) / sum(sent) AS buy_30d,
  sum(revenue * w) / sum(sent * w) AS rps_decayed, sum(revenue * sent * w) / sum(sent * w) AS send_weighted_revenue,
  sum(sent) AS sends_30d, sum(revenue) AS revenue_30d, count(*) AS active_days, avg(trend) AS trend, avg(stability) AS stability,
  quantile_disc(rps, 0.5) AS median_rps, quantile_disc(rps, 0.75) AS p75_rps, quantile_disc(rps, 0.25) AS p25_rps, stddev_samp(rps) AS rps_stddev
  FROM recent GROUP BY 1, 2, 3, 4),
h AS (SELECT account, template, max_by(hour, (r, -hour)) AS best_hour, max(r) AS best_hour_rps FROM (
  SELECT account, template, hour, avg(rps) AS r FROM c_hourly WHERE metric_date BETWEEN {TODAY} - 30 AND {TODAY} GROUP BY 1, 2, 3) GROUP BY 1, 2),
w AS (SELECT account, template, max_by(dow, (r, -dow)) AS best_weekday FROM (
  SELECT account, template, dayofweek(metric_date) + 1 AS dow, avg(rps) AS r FROM recent GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT b.*, best_hour, best_hour_rps, best_weekday, last_used_at AS last_sent_at, (epoch_us({NOW}) - epoch_us(last_used_at)) // 3600000000 AS hours_since_use
FROM b LEFT JOIN h USING (account, template) LEFT JOIN w USING (account, template) LEFT JOIN c_last_used USING (account, template)"""

SHARED_SQL["c_store"] = """
SELECT *, base_score * (1 + 0.3 * ucb) AS exploration_score, sends_30d / (sends_30d + 100) AS smoothing_weight,
  CASE WHEN hours_since_use < 6 THEN false WHEN fatigue > 0.8 THEN false WHEN sends_30d < 10 THEN true ELSE hours_since_use > cooldown_hours END AS eligible,
  percent_rank() OVER (PARTITION BY account_page ORDER BY rps_smoothed) AS rps_pct,
  percent_rank() OVER (PARTITION BY category ORDER BY rps_smoothed) AS cat_pct
FROM (SELECT *, 0.4 * rps_smoothed / nullif(global_rps, 0) + 0.3 * stability + 0.2 * (1 - fatigue) + 0.1 * confidence AS base_score
FROM (SELECT *, (rps_30d * sends_30d + cat_rps * 100) / (sends_30d + 100) AS rps_smoothed, (buy_30d * sends_30d + cat_buy * 100) / (sends_30d + 100) AS buy_smoothed,
  least(1.0, sends_30d / 1000) * stability AS confidence, 2 * sqrt(2 * ln(1 + total_sends) / greatest(1, sends_30d)) AS ucb,
  1 / (1 + exp(-0.1 * (30 - least(30, hours_since_use / 24)))) AS temperature,
  CASE WHEN sends_30d < 10 THEN 1.0 WHEN sends_30d < 50 THEN 0.5 WHEN sends_30d < 100 THEN 0.2 ELSE 0 END AS novelty,
  6 * 1.5 ** least(5, active_days / 7) AS cooldown_hours, 1 / (1 + exp(-0.5 * (active_days - 15))) AS fatigue
FROM (SELECT *, avg(rps_30d) OVER () AS global_rps, sum(sends_30d) OVER () AS total_sends,
  avg(rps_30d) OVER (PARTITION BY category) AS cat_rps, avg(buy_30d) OVER (PARTITION BY category) AS cat_buy FROM c_store_base)))"""


@product(
    "feature_store",
    "account template account_page category rps_30d:r rps_decayed:r send_weighted_revenue:r rps_smoothed:r buy_30d:r buy_smoothed:r sends_30d:i "
    "trend:r stability:r confidence:r median_rps:r p75_rps:r p25_rps:r rps_stddev:r ucb:r temperature:r novelty:r smoothing_weight:r best_hour:i "
    "best_hour_rps:r best_weekday:i hours_since_use:i last_sent_at:t active_days:i cooldown_hours:r fatigue:r eligible base_score:r "
    "exploration_score:r rps_pct:r cat_pct:r",
    "SELECT * REPLACE(coalesce(rps_stddev, 0) AS rps_stddev) FROM c_store",
)
def _(spark, d):
    return store(spark, d).select(
        "account", "template", "account_page", "category", "performance.*", "distribution.*", "exploration.*", "timing.*", "cooldown.*", "scores.*"
    )


def ready(spark, d):
    f = sem.facts(spark, d)
    return features.rank_ready(store(spark, d), semantic.behaviour(f, AS_OF), semantic.intensity(f, AS_OF))


SHARED_SQL["c_bandit"] = """
SELECT * FROM (VALUES ('high', 1.0::DOUBLE, 1.0::DOUBLE, 0.05::DOUBLE, 2.0::DOUBLE), ('medium', 1.0, 1.0, 0.10, 1.5), ('low', 1.0, 1.0, 0.15, 1.0)) t(tier, alpha, beta, epsilon, ucb_c)"""
SHARED_SQL["c_ready"] = """
SELECT s.*, coalesce(slump, 0) * 0.5 AS risk, night_owl, i.tier,
  CASE WHEN spend_per_txn > 50 THEN 'premium' WHEN spend_per_txn > 20 THEN 'standard' ELSE 'budget' END AS price_stance, epsilon, ucb_c, alpha, beta
FROM c_store s LEFT JOIN c_behaviour USING (account) LEFT JOIN c_intensity i USING (account) LEFT JOIN c_bandit USING (tier)"""


@product("rank_ready", "account template risk:r night_owl tier price_stance epsilon:r ucb_c:r rps_smoothed:r eligible", "SELECT * FROM c_ready")
def _(spark, d):
    return ready(spark, d).select("*", "performance.rps_smoothed", "cooldown.eligible")


_SEED = ("account_page", "'2024-01-31 00'", "template")
_POLICY = {
    "ucb": "rps_smoothed + bonus",
    "epsilon_greedy": f"CASE WHEN {hash_uniform(*_SEED)} < coalesce(epsilon, 0.1) THEN {hash_uniform(*_SEED, chr(39) + 'explore' + chr(39))} ELSE rps_smoothed END",
    "thompson": f"(1 + buy_30d * sends_30d) / (2 + sends_30d) + 0.01 * {hash_uniform(*_SEED)}",
    "mean": "rps_smoothed",
}


def _policy(mode: str, sql: str):
    @product(
        f"rank_templates_{mode}",
        "account_page template score:r baseline:r bonus:r mode rank:i",
        f"""SELECT *, row_number() OVER (PARTITION BY account_page ORDER BY score DESC, template) AS rank FROM (
          SELECT account_page, template, {sql} AS score, rps_smoothed AS baseline, bonus, '{mode}' AS mode FROM (
            SELECT *, coalesce(ucb_c, 1.0) * sqrt(ln(greatest(sum(sends_30d) OVER (PARTITION BY account_page), 1)) * 2 / greatest(sends_30d, 1)) AS bonus
            FROM c_ready WHERE eligible)) QUALIFY rank <= 5""",
    )
    def _(spark, d):
        return rank.rank_templates(ready(spark, d), AS_OF, 5, mode)


for _mode, _sql in _POLICY.items():
    _policy(_mode, _sql)

_SLOT = ("template", "strftime(slot_at, '%Y%m%d%H')")
SHARED_SQL["c_slot_scores"] = f"""
SELECT *, hour(slot_at) AS slot_hour, CASE WHEN {hash_int(*_SLOT)} % 100 < 10 THEN {hash_uniform(*_SLOT, "'explore'")}
    ELSE 0.4 * rps_pct + 0.2 * ucb + 0.2 * recency_part + 0.2 * stability END
  * CASE WHEN hour(slot_at) = best_hour THEN 1.2 WHEN abs(hour(slot_at) - best_hour) <= 2 THEN 1.1 ELSE 1.0 END AS score
FROM (SELECT *, 1 - exp(-0.1 * hours_since_use / 24) AS recency_part, unnest(range({NOW}, {NOW} + INTERVAL 25 HOUR, INTERVAL 1 HOUR)) AS slot_at FROM c_store WHERE eligible)"""
SHARED_SQL["c_slot_ranking"] = """
SELECT *, rps_pct AS performance_part, ucb AS exploration_part, stability AS stability_part, rps_smoothed AS expected_rps, ucb > rps_pct AS is_exploration,
  hours_since_use / 24 AS days_since_use, sends_30d AS recent_sends,
  CASE WHEN rank = 1 THEN 'primary' WHEN rank <= 3 THEN 'secondary' WHEN rank <= 5 THEN 'backup' ELSE 'alternative' END AS recommendation
FROM (SELECT *, row_number() OVER (PARTITION BY account_page, slot_at ORDER BY score DESC, template) AS rank,
  percent_rank() OVER (PARTITION BY account_page, slot_at ORDER BY score) AS score_pct FROM c_slot_scores) WHERE rank <= 10"""


@layer("slot_ranking")
def slot_ranking(spark, d):
    return rank.slot_ranking(store(spark, d), AS_OF)


@product(
    "slot_ranking",
    "account_page template slot_at:t slot_hour:i rank:i score:r score_pct:r performance_part:r exploration_part:r recency_part:r stability_part:r "
    "expected_rps:r confidence:r days_since_use:r recent_sends:i recommendation is_exploration",
    "SELECT * FROM c_slot_ranking",
)
def _(spark, d):
    return slot_ranking(spark, d)


SHARED_SQL["c_recommended"] = """
SELECT account_page, CAST(slot_at AS DATE) AS schedule_date, slot_hour AS schedule_hour, r.template, substr(body, 1, 200) AS preview, t.category,
  rank, score, expected_rps, confidence, days_since_use, recommendation, is_exploration
FROM c_slot_ranking r JOIN c_templates t USING (template) WHERE rank <= 5"""


def recommended(spark, d):
    return rank.schedule_recommendations(slot_ranking(spark, d), src.templates(spark, d))


@product(
    "schedule_recommendations",
    "account_page schedule_date:d schedule_hour:i template preview category rank:i score:r expected_rps:r confidence:r recommendation is_exploration",
    "SELECT * FROM c_recommended",
)
def _(spark, d):
    return recommended(spark, d)


@product(
    "selected_templates",
    "account_page schedule_date:d schedule_hour:i template pick:i strategy",
    f"""SELECT *, 'exploit' AS strategy, row_number() OVER (s ORDER BY score DESC, template) AS pick FROM c_recommended
        WINDOW s AS (PARTITION BY account_page, schedule_date, schedule_hour) QUALIFY pick <= 3
      UNION ALL
      SELECT *, 'explore' AS strategy, row_number() OVER (PARTITION BY account_page, schedule_date, schedule_hour
        ORDER BY CASE WHEN is_exploration THEN 0 ELSE 1 END, score DESC, template) AS pick FROM c_recommended QUALIFY pick <= 3
      UNION ALL
      SELECT *, 'balanced' AS strategy, row_number() OVER (PARTITION BY account_page, schedule_date, schedule_hour
        ORDER BY CASE WHEN {hash_uniform('account_page', 'schedule_hour', 'template')} < 0.1 THEN 0 ELSE 1 END, score DESC, template) AS pick
      FROM c_recommended QUALIFY pick <= 3""",
)
def _(spark, d):
    r = recommended(spark, d)
    out = [rank.select_templates(r, s).withColumn("strategy", F.lit(s)) for s in ("exploit", "explore", "balanced")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@product(
    "template_lookup",
    "template category body_length:i tier available last_used_at:t days_since_use:i expected_rps:r confidence:r",
    f"""SELECT t.template, t.category, length(body) AS body_length, CASE WHEN r >= 1 THEN 'top' WHEN r >= 0.5 THEN 'good' WHEN r >= 0.2 THEN 'average'
        WHEN r IS NULL THEN 'new' ELSE 'explore' END AS tier, coalesce(ok, true) AS available, last_used_at,
        coalesce((epoch_us({NOW}) - epoch_us(last_used_at)) // 86400000000, -1) AS days_since_use, coalesce(r, 0) AS expected_rps, coalesce(c, 0) AS confidence
      FROM c_templates t LEFT JOIN (SELECT template, avg(rps_smoothed) AS r, avg(confidence) AS c, bool_and(eligible) AS ok, max(last_sent_at) AS last_used_at
        FROM c_store GROUP BY 1) USING (template)""",
)
def _(spark, d):
    return rank.template_lookup(store(spark, d), src.templates(spark, d), AS_OF).fillna(-1, ["days_since_use"])


@layer("template_performance")
def performance(spark, d):
    return features.template_performance(sem.facts(spark, d), src.accounts(spark, d), AS_OF)


_DECAY = f"0.95 ** ({TODAY} - sent_date)"
SHARED_SQL["c_perf_base"] = f"""
WITH s AS (SELECT * FROM c_facts WHERE sent > 0 AND sent_at < {NOW}),
g AS (SELECT avg(purchased / sent) AS buy, avg(earnings::DOUBLE / sent) AS rps, avg(viewed / sent) AS opened, count(*) AS n FROM s),
p AS (SELECT account, template, sum(sent) AS total_sent, sum(sent * {_DECAY}) AS w_sent, sum(viewed * {_DECAY}) AS w_viewed, sum(purchased * {_DECAY}) AS w_bought,
  sum(earnings::DOUBLE * {_DECAY}) AS w_revenue, max(sent_at) AS last_used_at, count(DISTINCT sent_date) AS days_used, count(DISTINCT price) AS price_points,
  stddev_samp(purchased / sent) AS buy_sd, stddev_samp(earnings::DOUBLE / sent) AS rps_sd, {TODAY} - CAST(max(sent_at) AS DATE) AS idle FROM s GROUP BY 1, 2)
SELECT p.*, account_page, idle AS days_since_used, (w_bought + buy * k) / (w_sent + k) AS conversion, (w_revenue + rps * k) / (w_sent + k) AS rps,
  (w_viewed + opened * k) / (w_sent + k) AS open_rate, least(1.0, sqrt(2 * ln(n) / greatest(1, w_sent)) + coalesce(buy_sd, 0.1) * 2) AS exploration,
  CASE WHEN idle < 7 THEN exp(-0.5 * (7 - idle)) ELSE 1 END AS novelty, CASE WHEN days_used > 20 THEN 0.7 WHEN days_used > 10 THEN 0.85 ELSE 1 END AS usage_factor
FROM (SELECT *, least(30, greatest(5, 100 - w_sent)) AS k FROM p) p JOIN c_accounts USING (account), g"""


def _norm(m: str) -> str:
    return (
        f"percent_rank() OVER (PARTITION BY account_page ORDER BY {m}) AS {m}_pct, "
        f"coalesce(({m} - avg({m}) OVER w) / nullif(stddev_samp({m}) OVER w, 0), 0) AS {m}_z"
    )


SHARED_SQL["c_perf"] = f"""
SELECT *, total_sent < 10 AS cold_start, days_since_used > 28 AS stale, {_norm('conversion')}, {_norm('rps')}, {_norm('open_rate')}
FROM c_perf_base WINDOW w AS (PARTITION BY account_page)"""


@product(
    "template_performance",
    "account account_page template total_sent:i days_used:i price_points:i last_used_at:t conversion:r rps:r open_rate:r exploration:r days_since_used:i "
    "novelty:r usage_factor:r conversion_pct:r rps_pct:r open_rate_pct:r conversion_z:r rps_z:r open_rate_z:r cold_start stale",
    "SELECT * FROM c_perf",
)
def _(spark, d):
    return performance(spark, d)


SHARED_SQL["c_weights"] = f"""
WITH daily AS (SELECT account, local_date, CAST(sum(earnings) AS DOUBLE) AS rev, count(*) AS n FROM c_local GROUP BY 1, 2),
t AS (SELECT account, regr_slope(rev, local_date - DATE '2000-01-01') AS slope, avg(rev) AS mean_rev, sum(n) AS obs FROM daily GROUP BY 1),
h AS (SELECT account, {ratio('max(rev)', 'avg(rev)')} AS peak FROM (SELECT account, hod, CAST(sum(earnings) AS DOUBLE) AS rev FROM c_local GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT account, corr(price::DOUBLE, earnings::DOUBLE) AS r, count(*) AS n FROM c_local WHERE price > 0 GROUP BY 1)
SELECT t.account, least(1.6, greatest(0.8, coalesce(volume_boost, 1) + 0.5 * coalesce({ratio('t.slope', 'mean_rev')}, 0))) AS weight_volume,
  least(1.15, greatest(0.9, 1 + 0.05 * (coalesce(peak, 1) - 1))) AS weight_hours,
  least(1.5, greatest(0.9, 1 + 0.5 * coalesce(r, 0) * coalesce(c.n / (c.n + 30), 0))) AS weight_price,
  least(0.25, greatest(0.1, 0.25 - 0.15 * obs / (obs + 100))) AS exploration_rate
FROM t JOIN h USING (account) LEFT JOIN c USING (account) LEFT JOIN c_volume_profile USING (account)"""


@layer("personal_weights")
def weights(spark, d):
    return features.personal_weights(sem.local(spark, d), semantic.volume_profile(sem.local(spark, d, 28)))


@product("personal_weights", "account weight_volume:r weight_hours:r weight_price:r exploration_rate:r", "SELECT * FROM c_weights")
def _(spark, d):
    return weights(spark, d)
