"""Feature store and template features for ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outpulse.functions import clock
from outpulse.functions.numeric import correlation, dsum, half_life, ladder, logistic, num, power_decay, ratio, shrink
from outpulse.operators.joins import group_stats, overall, salted_lookup
from outpulse.operators.ranking import with_percent_ranks
from outpulse.plans.ingest import FEE_KEPT
from outpulse.plans.semantic import ACCURACY, valid_sends
from outpulse.session import stabilise

KEY = ["account", "template"]


@dataclass(frozen=True)
class FeatureParams:
    smoothing: float = 100.0
    ucb_c: float = 2.0
    half_life_days: float = 14.0
    min_cooldown_hours: float = 6.0
    fatigue_limit: float = 0.8


def feature_store(
    daily: DataFrame, facts: DataFrame, as_of: str, params: FeatureParams = FeatureParams()
) -> DataFrame:
    """Six nested feature groups per account x template for one day."""
    p, today = params, clock.day(as_of)
    recent = daily.where(clock.day_within("metric_date", as_of, 30))
    w = half_life(clock.days_between(today, "metric_date"), p.half_life_days)
    base = recent.groupBy(*KEY, "account_page", "category").agg(
        ratio(F.sum("revenue"), F.sum("sent")).alias("rps_30d"),
        ratio(F.sum("purchased"), F.sum("sent")).alias("buy_30d"),
        ratio(F.sum(F.col("revenue") * w), F.sum(F.col("sent") * w)).alias("rps_decayed"),
        ratio(F.sum(F.col("revenue") * F.col("sent") * w), F.sum(F.col("sent") * w)).alias("send_weighted_revenue"),
        F.sum("sent").alias("sends_30d"), F.sum("revenue").alias("revenue_30d"),
        F.count(F.lit(1)).alias("active_days"), F.avg("trend").alias("trend"), F.avg("stability").alias("stability"),
        F.percentile_approx("rps", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(ACCURACY)).alias("q"),
        F.stddev("rps").alias("rps_stddev"),
    )
    hours = (
        recent.select(*KEY, F.explode("hourly").alias("h")).groupBy(*KEY, "h.hour").agg(F.avg("h.rps").alias("r"))
        .groupBy(*KEY).agg(F.max_by("hour", F.struct("r", -F.col("hour"))).alias("best_hour"), F.max("r").alias("best_hour_rps"))
    )
    days = (
        recent.groupBy(*KEY, clock.sunday_based("metric_date").alias("dow")).agg(F.avg("rps").alias("r"))
        .groupBy(*KEY).agg(F.max_by("dow", F.struct("r", -F.col("dow"))).alias("best_weekday"))
    )
    last = valid_sends(facts).where(clock.within_days("sent_at", as_of, 90)).groupBy(*KEY).agg(
        F.max("sent_at").alias("last_sent_at")
    )
    base = stabilise(base.join(hours, KEY, "left").join(days, KEY, "left").join(last, KEY, "left"))
    g = overall(base, rps=F.avg("rps_30d"), buy=F.avg("buy_30d"), total=F.sum("sends_30d"))
    b = group_stats(base, ["category"], cat_rps=F.avg("rps_30d"), cat_buy=F.avg("buy_30d"))
    n, idle = F.col("sends_30d"), F.col("hours_since_use")
    b = b.withColumns({
        "global_rps": g["rps"], "global_buy": g["buy"], "total_sends": g["total"],
        "hours_since_use": clock.whole_units("HOUR", "last_sent_at", clock.moment(as_of)),
    })
    b = b.withColumns({
        "rps_smoothed": shrink(F.col("rps_30d") * n, n, F.coalesce("cat_rps", "global_rps"), p.smoothing),
        "buy_smoothed": shrink(F.col("buy_30d") * n, n, F.coalesce("cat_buy", "global_buy"), p.smoothing),
        "confidence": F.least(F.lit(1.0), n / 1000) * F.coalesce("stability", F.lit(0.5)),
        "ucb": p.ucb_c * F.sqrt(2 * F.ln(1 + F.col("total_sends")) / F.greatest(F.lit(1), n)),
        "temperature": logistic(0.1 * (30 - F.least(F.lit(30.0), F.coalesce(idle / 24, F.lit(30.0))))),
        "novelty": F.when(n < 10, 1.0).when(n < 50, 0.5).when(n < 100, 0.2).otherwise(0.0),
        "cooldown_hours": p.min_cooldown_hours * F.greatest(F.lit(1.0), F.pow(F.lit(1.5), F.least(F.lit(5.0), F.col("active_days") / 7))),
        "fatigue": logistic(0.5 * (F.col("active_days") - 15)),
        "idle_hours": F.coalesce(idle, F.lit(999)),
    })
    b = b.withColumn(
        "base_score",
        0.4 * ratio("rps_smoothed", "global_rps") + 0.3 * F.coalesce("stability", F.lit(0.5))
        + 0.2 * (1 - F.col("fatigue")) + 0.1 * F.col("confidence"),
    ).withColumn(
        "eligible",
        F.when(F.col("idle_hours") < p.min_cooldown_hours, False).when(F.col("fatigue") > p.fatigue_limit, False)
        .when(n < 10, True).otherwise(F.col("idle_hours") > F.col("cooldown_hours")),
    )
    r = with_percent_ranks(b, [("rps_pct", ["account_page"], "rps_smoothed"), ("cat_pct", ["category"], "rps_smoothed")])

    def c0(x):
        return F.coalesce(x, F.lit(0.0)).alias(x)

    return r.select(
        *KEY, "account_page", "category",
        F.struct(
            c0("rps_30d"), F.coalesce("rps_decayed", "rps_30d").alias("rps_decayed"), c0("rps_smoothed"), c0("buy_30d"),
            c0("buy_smoothed"), c0("revenue_30d"), "sends_30d", c0("trend"),
            F.coalesce("stability", F.lit(0.5)).alias("stability"), c0("confidence"), "send_weighted_revenue",
        ).alias("performance"),
        F.struct(
            F.col("q")[1].alias("median_rps"), F.col("q")[2].alias("p75_rps"), F.col("q")[0].alias("p25_rps"),
            c0("rps_stddev"), (F.col("q")[2] - F.col("q")[0]).alias("iqr"), ratio("rps_stddev", F.col("q")[1]).alias("variation"),
        ).alias("distribution"),
        F.struct("ucb", "temperature", "novelty", (n / (n + p.smoothing)).alias("smoothing_weight")).alias("exploration"),
        F.struct(
            F.coalesce("best_hour", F.lit(12)).alias("best_hour"), F.coalesce("best_hour_rps", "rps_30d").alias("best_hour_rps"),
            F.coalesce("best_weekday", F.lit(4)).alias("best_weekday"), F.col("idle_hours").alias("hours_since_use"),
            "last_sent_at", "active_days",
        ).alias("timing"),
        F.struct("cooldown_hours", "fatigue", "eligible").alias("cooldown"),
        F.struct(
            "base_score", (F.col("base_score") * (1 + 0.3 * F.col("ucb"))).alias("exploration_score"), "rps_pct", "cat_pct"
        ).alias("scores"),
        today.alias("computed_date"),
    )


@dataclass(frozen=True)
class BanditParams:
    """Exploration settings per account tier."""

    tier: str
    alpha: float
    beta: float
    epsilon: float
    ucb_c: float
    base_cooldown_hours: float


# Bandit settings per tier.
BANDIT = (
    BanditParams("high", 1.0, 1.0, 0.05, 2.0, 24.0),
    BanditParams("medium", 1.0, 1.0, 0.10, 1.5, 36.0),
    BanditParams("low", 1.0, 1.0, 0.15, 1.0, 48.0),
)


def rank_ready(store: DataFrame, behaviour: DataFrame, intensity: DataFrame) -> DataFrame:
    """Latest features with account behaviour, price stance and bandit settings."""
    spark = store.sparkSession
    bandit = spark.createDataFrame([(b.tier, b.alpha, b.beta, b.epsilon, b.ucb_c, b.base_cooldown_hours) for b in BANDIT],
                                   "tier string, alpha double, beta double, epsilon double, ucb_c double, base_cooldown_hours double")
    side = behaviour.select("account", (F.coalesce("slump", F.lit(0.0)) * 0.5).alias("risk"), "night_owl").join(
        intensity.select("account", "spend_per_txn", "tier"), "account", "full"
    ).join(bandit, "tier", "left")
    spend = F.col("spend_per_txn")
    return salted_lookup(store, side, ["account"]).withColumn(
        "price_stance", F.when(spend > 50, "premium").when(spend > 20, "standard").otherwise("budget")
    )


def template_performance(facts: DataFrame, accounts: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Smoothed, decayed and normalised measures per account x template."""
    sends = facts.where(clock.within_days("sent_at", as_of, days) & (F.col("sent") > 0) & F.col("template").isNotNull())
    buy, rps, opened = ratio("purchased", "sent"), ratio("earnings", "sent"), ratio("viewed", "sent")
    g = overall(sends, buy=F.avg(buy), rps=F.avg(rps), opened=F.avg(opened), n=F.count(F.lit(1)))
    d = power_decay(clock.days_between(clock.day(as_of), "sent_date"))
    perf = sends.groupBy(*KEY).agg(
        F.sum("sent").alias("total_sent"), F.sum(F.col("sent") * d).alias("w_sent"), F.sum(F.col("viewed") * d).alias("w_viewed"),
        F.sum(F.col("purchased") * d).alias("w_bought"), F.sum(num("earnings") * d).alias("w_revenue"),
        F.max("sent_at").alias("last_used_at"), F.countDistinct("sent_date").alias("days_used"),
        F.countDistinct("price").alias("price_points"), F.stddev(buy).alias("buy_sd"), F.stddev(rps).alias("rps_sd"),
    )
    perf = salted_lookup(perf, accounts.select("account", "account_page"), ["account"], "inner")
    perf = perf.withColumns({"_g_buy": g["buy"], "_g_rps": g["rps"], "_g_open": g["opened"], "_g_n": g["n"]})
    prior = F.least(F.lit(30.0), F.greatest(F.lit(5.0), 100 - F.col("w_sent")))
    idle = clock.days_between(clock.day(as_of), F.to_date("last_used_at"))
    f = perf.select(
        *KEY, "account_page", "total_sent", "days_used", "price_points", "last_used_at", "buy_sd", "rps_sd",
        shrink("w_bought", "w_sent", "_g_buy", prior).alias("conversion"),
        shrink("w_revenue", "w_sent", "_g_rps", prior).alias("rps"),
        shrink("w_viewed", "w_sent", "_g_open", prior).alias("open_rate"),
        F.least(F.lit(1.0), F.sqrt(2 * F.ln(num("_g_n")) / F.greatest(F.lit(1.0), F.col("w_sent"))) + F.coalesce("buy_sd", F.lit(0.1)) * 2).alias("exploration"),
        idle.alias("days_since_used"),
        F.when(idle < 7, F.exp(-0.5 * (7 - idle))).otherwise(F.lit(1.0)).alias("novelty"),
        ladder("days_used", (21, 0.7), (11, 0.85), default=1.0).alias("usage_factor"),
    )
    f = with_percent_ranks(f, [(f"{m}_pct", ["account_page"], m) for m in ("conversion", "rps", "open_rate")])
    z = group_stats(f, ["account_page"], **{f"_a_{m}": F.avg(m) for m in ("conversion", "rps", "open_rate")},
                    **{f"_s_{m}": F.stddev(m) for m in ("conversion", "rps", "open_rate")})
    return z.withColumns({
        **{f"{m}_z": F.coalesce(ratio(F.col(m) - F.col(f"_a_{m}"), f"_s_{m}"), F.lit(0.0)) for m in ("conversion", "rps", "open_rate")},
        "cold_start": F.col("total_sent") < 10, "stale": F.col("days_since_used") > 28,
    }).drop(*[f"_{k}_{m}" for k in "as" for m in ("conversion", "rps", "open_rate")])


def personal_weights(local: DataFrame, boost: DataFrame, prior_obs: float = 30.0) -> DataFrame:
    """Per-account planning weights, each held inside its range: volume from
    the fitted boost and the daily trend, hours from the peak share, price from
    the shrunk price-revenue correlation, exploration from sample size."""
    daily = local.groupBy("account", "local_date").agg(dsum("earnings").alias("rev"), F.count(F.lit(1)).alias("n"))
    origin = F.lit("2000-01-01").cast("date")
    trend = daily.groupBy("account").agg(
        F.regr_slope("rev", num(F.datediff("local_date", origin))).alias("slope"), F.avg("rev").alias("mean_rev"), F.sum("n").alias("obs")
    )
    hours = local.groupBy("account", "hod").agg(dsum("earnings").alias("rev")).groupBy("account").agg(
        ratio(F.max("rev"), F.avg("rev")).alias("peak")
    )
    corr = local.where(F.col("price") > 0).groupBy("account").agg(
        correlation(num("price"), num("earnings")).alias("r"), F.count(F.lit(1)).alias("paid_n")
    )
    j = trend.join(hours, "account").join(corr, "account", "left").join(boost.select("account", "volume_boost"), "account", "left")
    r = F.coalesce(F.col("r"), F.lit(0.0)) * F.coalesce(F.col("paid_n") / (F.col("paid_n") + prior_obs), F.lit(0.0))

    def within(x, low, high):
        return F.least(F.lit(high), F.greatest(F.lit(low), x))

    return j.select(
        "account",
        within(F.coalesce("volume_boost", F.lit(1.0)) + 0.5 * F.coalesce(ratio("slope", "mean_rev"), F.lit(0.0)), 0.80, 1.60).alias("weight_volume"),
        within(1 + 0.05 * (F.coalesce("peak", F.lit(1.0)) - 1), 0.90, 1.15).alias("weight_hours"),
        within(1 + 0.5 * r, 0.90, 1.50).alias("weight_price"),
        within(F.lit(0.25) - 0.15 * F.col("obs") / (F.col("obs") + 100), 0.10, 0.25).alias("exploration_rate"),
    )
