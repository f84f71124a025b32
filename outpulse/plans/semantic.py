"""Daily performance, account profiles and their slower-moving summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.functions import clock, text
from outpulse.functions.numeric import correlation, dsum, half_life, ladder, num, ratio, shrink, strict_least
from outpulse.operators.joins import salted_lookup
from outpulse.operators.ranking import top_k, with_percent_ranks
from outpulse.plans.ingest import FEE_KEPT

ACCURACY = 10000


def quantile(c, p: float) -> Column:
    """Sketched quantile: mergeable, bounded memory per group."""
    return F.percentile_approx(num(c), F.lit(p), F.lit(ACCURACY))


def valid_sends(facts: DataFrame) -> DataFrame:
    return facts.where(
        (F.col("sent") > 0) & (F.col("viewed") <= F.col("sent")) & (F.col("purchased") <= F.col("viewed"))
    )


def daily_performance(
    facts: DataFrame, accounts: DataFrame, templates: DataFrame, as_of: str, days: int = 180
) -> DataFrame:
    """Template x account x day: volumes, rates, quantiles, rolling means,
    trend, stability, percentile ranks and a tier.

    Rolling frames count rows (days with sends).  Sends are summed per hour
    first, so the hourly array has at most 24 entries.
    """
    rps = ratio(num("earnings") * FEE_KEPT, "sent")
    sends = (
        valid_sends(facts)
        .where(clock.within_days("sent_at", as_of, days))
        .select("account", "template", "sent_date", F.hour("sent_at").alias("hour"),
                "sent", "viewed", "purchased", "earnings", "price", rps.alias("send_rps"))
    )
    keys = ["sent_date", "template", "account"]
    daily = sends.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sends"), F.sum("sent").alias("sent"), F.sum("viewed").alias("viewed"),
        F.sum("purchased").alias("purchased"), F.sum("earnings").alias("gross"),
        F.avg(num("price")).alias("avg_price"),
        F.percentile_approx("send_rps", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(ACCURACY)).alias("q"),
    )
    hours = (
        sends.groupBy(*keys, "hour")
        .agg(F.sum("sent").alias("s"), ratio(dsum("earnings") * FEE_KEPT, F.sum("sent")).alias("r"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("hour", F.col("s").alias("sends"), F.col("r").alias("rps")))).alias("hourly"))
    )
    base = daily.join(hours, keys)
    base = salted_lookup(base, templates.select("template", "category"), ["template"], "inner")
    base = salted_lookup(base, accounts.select("account", "account_page"), ["account"], "inner")
    base = base.select(
        F.col("sent_date").alias("metric_date"), "template", "account", "account_page", "category",
        "sends", "sent", "viewed", "purchased", num("gross").alias("revenue"), "avg_price",
        ratio("viewed", "sent").alias("view_rate"), ratio("purchased", "sent").alias("purchase_rate"),
        ratio(num("gross") * FEE_KEPT, "sent").alias("rps"),
        F.col("q")[1].alias("median_rps"), F.col("q")[2].alias("p75_rps"), F.col("q")[0].alias("p25_rps"),
        "hourly",
    )
    series = Window.partitionBy("account", "template")
    ordered = series.orderBy("metric_date")
    older = F.avg("rps").over(ordered.rowsBetween(-29, -15))
    rolled = base.select(
        "*",
        F.avg("rps").over(ordered.rowsBetween(-6, 0)).alias("rps_7"),
        F.avg("purchase_rate").over(ordered.rowsBetween(-6, 0)).alias("purchase_rate_7"),
        F.avg("rps").over(ordered.rowsBetween(-29, 0)).alias("rps_30"),
        F.coalesce(ratio(F.avg("rps").over(ordered.rowsBetween(-14, 0)) - older, older), F.lit(0.0)).alias("trend"),
        clock.days_between(clock.day(as_of), F.max("metric_date").over(series)).alias("days_since_use"),
    ).withColumn(
        "stability",
        F.when(
            F.col("rps_30") > 0,
            1 - strict_least(F.lit(1.0), F.abs(F.col("p75_rps") - F.col("p25_rps")) / (2 * F.col("rps_30"))),
        ).otherwise(F.lit(0.0)),
    )
    ranked = with_percent_ranks(
        rolled,
        [("pct_in_account", ["account", "metric_date"], "rps"), ("pct_in_category", ["category", "metric_date"], "rps")],
    )
    return ranked.withColumn(
        "performance_tier",
        ladder("pct_in_category", (0.9, "top_performer"), (0.7, "strong_performer"), (0.3, "average_performer"),
               default="under_performer"),
    )


def template_features(templates: DataFrame) -> DataFrame:
    """Style, level and theme of whole texts; each text is split once."""
    t = F.col("_tokens")
    return templates.withColumn("_tokens", text.tokens("body")).select(
        "template", "category", "lang",
        text.word_count("body").alias("words"), text.emoji_count("body").alias("emojis"),
        text.length_bin("body").alias("length_bin"), text.emoji_bin("body").alias("emoji_bin"),
        text.has_cta("body", t).alias("has_cta"), text.has_urgency("body", t).alias("has_urgency"),
        text.ends_with_question("body").alias("ends_with_question"),
        text.content_level("body", pieces=t).alias("content_level"),
        text.theme_tags("body", t).alias("theme_tags"),
    )


def in_play(templates: DataFrame, facts: DataFrame) -> DataFrame:
    """Templates that some send used: text work is then done only on those."""
    return templates.join(facts.select("template").distinct(), "template", "left_semi")


# Vocabularies of the energy score, strong then weak.
URGENT = ("exclusive|limited|now|today|tonight|urgent|hurry|quick|fast|expiring|expires",
          "special|hot|ready|wait|soon|almost|ending")
PERSONAL = ("love|miss you|thinking of you|dream|imagine|personal|private|just for you",
            "honey|darling|sweetie|special|close|together")
ACTION = ("click|watch|see|check|look|unlock|open|view|download|get|grab",
          "want|need|ready|come|join|experience|enjoy|try")


def engagement_scores(templates: DataFrame) -> DataFrame:
    """Energy of the copy from three graded vocabularies, emoji density,
    content level and questions."""
    low = F.lower("body")

    def grade(words) -> Column:
        return F.when(low.rlike(words[0]), 3).when(low.rlike(words[1]), 2).otherwise(1)

    level = F.when(text.content_level("body") == "explicit", 3).when(text.content_level("body") == "moderate", 2).otherwise(1)
    f = templates.where(F.col("body").isNotNull()).select(
        "template", grade(URGENT).alias("urgency"), grade(PERSONAL).alias("closeness"), grade(ACTION).alias("action"),
        text.emoji_count("body").alias("emojis"), F.length("body").alias("body_length"),
        level.alias("intensity"), F.when(F.col("body").contains("?"), 1).otherwise(0).alias("has_question"),
    )
    return f.select(
        "*",
        ratio(F.col("urgency") + F.col("closeness") + F.col("action"), F.lit(9)).alias("energy"),
        (ratio("emojis", "body_length") * 100).alias("emoji_density"),
    ).withColumn(
        "engagement",
        F.col("energy") * 0.4 + strict_least(F.col("emoji_density") / 10, F.lit(1.0)) * 0.2
        + F.col("intensity") / 3 * 0.3 + F.col("has_question") * 0.1,
    )


def last_used(facts: DataFrame, as_of: str, days: int = 365) -> DataFrame:
    return (
        valid_sends(facts).where(clock.within_days("sent_at", as_of, days))
        .groupBy("account", "template").agg(F.max("sent_at").alias("last_used_at"))
    )


LEVEL_ORDER = ("mild", "pending_review", "moderate", "explicit")


def safe_candidates(features: DataFrame, pairs: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account x template pairs whose content level the account allows."""
    levels = F.array(*[F.lit(x) for x in LEVEL_ORDER])
    allowed = F.when(F.col("page_type") == "free", F.lit("pending_review")).when(
        F.col("page_type") == "main", F.lit("moderate")
    ).otherwise(F.lit("explicit"))
    j = salted_lookup(pairs, features, ["template"], "inner")
    j = salted_lookup(j, accounts.select("account", "account_page", allowed.alias("max_level")), ["account"], "inner")
    return j.where(F.array_position(levels, F.col("content_level")) <= F.array_position(levels, F.col("max_level")))


def candidate_pool(safe: DataFrame, used: DataFrame, as_of: str, cooldown_days: int) -> DataFrame:
    cutoff = F.expr(f"timestamp_ntz'{as_of}' - interval {cooldown_days} days")
    return safe.join(used, ["account", "template"], "left").withColumn(
        "cooldown_ok", F.col("last_used_at").isNull() | (F.col("last_used_at") < cutoff)
    )


def engagement_patterns(facts: DataFrame, as_of: str, min_sends: int = 3) -> DataFrame:
    """Best (hour, weekday) windows and volume tier per account, 90 days."""
    hourly = (
        facts.where(clock.within_days("sent_at", as_of, 90))
        .groupBy("account", F.hour("sent_at").alias("hour"), clock.sunday_based("sent_at").alias("weekday"))
        .agg(
            F.avg(ratio("purchased", "sent")).alias("conversion"), F.avg(num("price")).alias("avg_price"),
            F.avg(num("earnings")).alias("avg_earnings"), F.stddev(num("earnings")).alias("volatility"),
            F.count(F.lit(1)).alias("messages"), dsum("earnings").alias("earnings"),
        )
        .where(F.col("messages") >= min_sends)
    )
    # At most 168 windows per account, so the sorted list is bounded.
    best = F.slice(
        F.sort_array(F.collect_list(F.struct(
            F.coalesce("conversion", F.lit(-1.0)).alias("conversion"), "avg_earnings", "messages",
            (-F.col("hour")).alias("neg_hour"), (-F.col("weekday")).alias("neg_weekday"))), asc=False), 1, 10)
    agg = hourly.groupBy("account").agg(
        best.alias("windows"),
        (1 - ratio(F.sqrt(F.avg(F.pow("volatility", F.lit(2)))), F.avg("avg_earnings"))).alias("consistency"),
        (F.count(F.lit(1)) / 168.0).alias("coverage"), correlation("avg_price", "conversion").alias("price_elasticity"),
        F.max("conversion").alias("peak_conversion"), F.avg("conversion").alias("avg_conversion"),
        F.sum("earnings").alias("earnings_90d"), F.sum("messages").alias("messages_90d"),
    )
    return agg.select(
        "*",
        F.transform("windows", lambda w: F.concat_ws("@", -w.neg_hour, -w.neg_weekday)).alias("top_windows"),
        ratio(F.col("peak_conversion") - F.col("avg_conversion"), "avg_conversion").alias("conversion_volatility"),
        ladder("messages_90d", (1000, "HIGH_VOLUME"), (300, "MEDIUM_VOLUME"), (50, "LOW_VOLUME"), default="MINIMAL_VOLUME").alias("volume_tier"),
    ).drop("windows")


def hour_profile(facts: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Revenue per send by weekday and hour, its lift and rank in the day."""
    base = (
        valid_sends(facts).where(clock.within_days("sent_at", as_of, days))
        .groupBy("account", clock.sunday_based("sent_at").alias("weekday"), F.hour("sent_at").alias("hour"))
        .agg(ratio(dsum("earnings"), F.sum("sent")).alias("rps"), F.countDistinct("sent_date").alias("sample_days"))
    )
    # 168 rows per account at most: windows over an account are bounded here.
    w = Window.partitionBy("account")
    return base.select(
        "*", ratio("rps", F.avg("rps").over(w)).alias("lift"),
        F.rank().over(Window.partitionBy("account", "weekday").orderBy(F.col("rps").desc())).alias("rank_in_day"),
    )


def behaviour(facts: DataFrame, as_of: str) -> DataFrame:
    """28-day ratios, change against the 28 days before, night share."""
    d, end = F.col("sent_date"), clock.day(as_of)
    recent = d.between(F.date_sub(end, 28), end)
    prior = d.between(F.date_sub(end, 56), F.date_sub(end, 29))
    night = (F.hour("sent_at") >= 20) | (F.hour("sent_at") <= 2)

    def total(cond, c):
        return F.sum(F.when(cond, F.col(c))).cast("double")

    s = valid_sends(facts).where(d.between(F.date_sub(end, 56), end)).groupBy("account").agg(
        total(recent, "earnings").alias("rev"), total(recent, "sent").alias("sent"),
        total(recent, "purchased").alias("bought"), total(prior, "earnings").alias("rev0"),
        total(prior, "sent").alias("sent0"), total(recent & night, "earnings").alias("night"),
        F.countDistinct(F.when(recent, d)).alias("active_days"),
    ).where(F.col("sent").isNotNull())
    s = s.withColumn("rps_28d", ratio("rev", "sent")).withColumn("rps_prior", ratio("rev0", "sent0"))
    return s.select(
        "account", "rps_28d", ratio("bought", "sent").alias("conversion"), "active_days",
        ratio(F.col("rps_28d") - F.col("rps_prior"), "rps_prior").alias("slump"),
        F.coalesce(ratio(F.coalesce("night", F.lit(0.0)), "rev") > 0.35, F.lit(False)).alias("night_owl"),
    )


def intensity(facts: DataFrame, as_of: str, renew_on: float = 0.7) -> DataFrame:
    b = (
        valid_sends(facts).where(clock.day_within("sent_date", as_of, 7)).groupBy("account")
        .agg(dsum("earnings").alias("earnings"), F.sum("sent").alias("sent"), F.sum("purchased").alias("bought"),
             F.countDistinct("sent_date").alias("active_days"))
    ).select(
        "account", ratio("earnings", "sent").alias("rps_7d"), "earnings",
        ratio("earnings", "bought").alias("spend_per_txn"), ratio("earnings", "active_days").alias("earn_per_day"), "active_days",
    )
    score = (
        0.3 * F.ln(1 + F.col("earnings")) + 0.2 * F.ln(1 + F.col("spend_per_txn"))
        + 0.2 * F.ln(1 + F.col("earn_per_day")) + 0.2 * F.lit(renew_on) + 0.1 * F.ln(1 + F.col("active_days"))
    )
    return b.withColumn("score", score).withColumn(
        "tier", F.when(F.col("score") > 5, "high").when(F.col("score") > 3, "medium").otherwise("low")
    )


def account_health(facts: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Seven-day account measures that the tier assignment scores."""
    s = facts.where(clock.day_within("sent_date", as_of, 7)).groupBy("account").agg(
        dsum("earnings").alias("earnings"), F.sum("purchased").alias("bought"),
    )
    return accounts.join(s, "account", "left").select(
        "account", num("active_fans").alias("active_fans"),
        F.coalesce("earnings", F.lit(0.0)).alias("earnings"),
        (F.coalesce("earnings", F.lit(0.0)) * FEE_KEPT).alias("message_net"),
        F.coalesce(ratio("earnings", "active_fans"), F.lit(0.0)).alias("earn_per_fan"),
        F.coalesce(ratio("earnings", "bought"), F.lit(0.0)).alias("spend_per_txn"),
        "renew_on_pct", F.log10(1 + num("active_fans")).alias("log_fans"),
    )


TIER_WEIGHTS = {"log_fans": 0.30, "message_net": 0.20, "earn_per_fan": 0.15, "spend_per_txn": 0.10,
                "earnings": 0.15, "renew_on_pct": 0.05}


def scored_health(health: DataFrame) -> DataFrame:
    """Weighted z-scores; the population moments are one-row subqueries, not a
    window over the whole table."""
    moments = health.agg(F.struct(*[f(c).alias(p + c) for c in TIER_WEIGHTS for p, f in (("a_", F.avg), ("s_", F.stddev_samp))]).alias("m"))
    total = None
    for c, w in TIER_WEIGHTS.items():
        z = F.lit(w) * F.coalesce(F.try_divide(F.col(c) - F.col(f"_m.a_{c}"), F.col(f"_m.s_{c}")), F.lit(0.0))
        total = z if total is None else total + z
    return health.withColumn("_m", moments.scalar()).withColumn("intensity", total).drop("_m")


def tier_thresholds(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("population"),
        *[quantile("intensity", q / 100).alias(f"q{q}") for q in (40, 60, 90)],
        quantile("active_fans", 0.7).alias("fans_p70"), quantile("message_net", 0.6).alias("net_p60"),
        quantile("message_net", 0.7).alias("net_p70"), quantile("earnings", 0.7).alias("earn_p70"),
    )


def tier_assignment(scored: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """Tier per account; stored thresholds win, else those of this population."""
    t = tier_thresholds(scored)
    if configured is not None:
        have = configured.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        t = configured.select(*t.columns).unionByName(t.where(have == 0))
    th = {c: F.col(f"_t.{c}") for c in t.columns}
    i, fans, net = F.col("intensity"), F.col("active_fans"), F.col("message_net")
    return scored.withColumn("_t", t.select(F.struct("*").alias("s")).scalar()).withColumn(
        "tier",
        F.when((net == 0) & (F.col("earnings") == 0) & (fans < 100), "LOW")
        .when((i >= th["q90"]) & (fans >= th["fans_p70"]) & ((net >= th["net_p70"]) | (F.col("earnings") >= th["earn_p70"])), "POWER")
        .when((i >= th["q60"]) & ((net >= th["net_p60"]) | (fans >= th["fans_p70"] * 0.8)), "HIGH")
        .when(i >= th["q40"], "MED").otherwise("LOW"),
    ).drop("_t")


def fatigue_scores(facts: DataFrame, as_of: str) -> DataFrame:
    """How worn a template is on an account: frequency x recency, 30 days."""
    age = clock.days_between(clock.day(as_of), F.to_date("last_at"))
    u = facts.where(clock.within_days("sent_at", as_of, 30)).groupBy("account", "template").agg(
        F.count(F.lit(1)).alias("uses"), F.max("sent_at").alias("last_at"), F.min("sent_at").alias("first_at"),
        F.array_sort(F.collect_set("sent_date")).alias("use_dates"),  # at most 30 dates
    )
    base = ladder("uses", (8, 1.0), (5, 0.8), (3, 0.5), (2, 0.3), default=0.1)
    score = base * F.greatest(F.lit(1.2) - age / 30.0, F.lit(0.5))
    return u.select(
        "account", "template", "uses", "last_at", F.size("use_dates").alias("use_days"),
        ratio(F.datediff(F.to_date("last_at"), F.to_date("first_at")), F.greatest(F.col("uses") - 1, F.lit(1))).alias("days_between_uses"),
        ratio("uses", F.size("use_dates")).alias("density"), age.alias("days_since_use"), score.alias("fatigue"),
    ).withColumn("fatigue_tier", ladder("fatigue", (0.8, "BURNT_OUT"), (0.5, "FATIGUED"), (0.3, "MODERATE"), default="FRESH"))


STYLE = ["length_bin", "emoji_bin", "has_cta", "has_urgency", "ends_with_question"]


def style_lift(dm: DataFrame, features: DataFrame, as_of: str, half_life_days: float = 45, k: float = 30) -> DataFrame:
    """Decayed revenue per send of a style against its slot, shrunk to it."""
    w = half_life(clock.whole_units("DAY", "sent_at", clock.moment(as_of)), half_life_days)
    base = dm.select("account_page", "dow", "hod", "template", "rps", w.alias("w"))
    slot = base.groupBy("account_page", "dow", "hod").agg(ratio(F.sum(F.col("rps") * F.col("w")), F.sum("w")).alias("baseline"))
    styled = salted_lookup(base, features.select("template", *STYLE), ["template"], "inner")
    agg = styled.groupBy("account_page", "dow", "hod", *STYLE).agg(
        F.count(F.lit(1)).alias("sends"), F.sum("w").alias("weight"),
        ratio(F.sum(F.col("rps") * F.col("w")), F.sum("w")).alias("rps_w"),
    )
    smooth = ratio(F.col("weight") * F.col("rps_w") + k * F.col("baseline"), F.col("weight") + k)
    return agg.join(slot, ["account_page", "dow", "hod"]).select(
        "*", (ratio("rps_w", "baseline") - 1).alias("lift"), (ratio(smooth, "baseline") - 1).alias("lift_smooth"),
    ).withColumn("lift_clamped", F.when(F.col("lift_smooth").isNotNull(), F.greatest(F.lit(-0.5), F.least(F.lit(0.5), F.col("lift_smooth")))))


def weekday_hour_scores(local: DataFrame, as_of: str, days_scale: float = 60.0) -> DataFrame:
    age = F.datediff(clock.day(as_of), F.col("local_date"))
    return local.groupBy("account", "dow", "hod").agg(F.sum(num("earnings") * F.exp(-age / days_scale)).alias("score"))


def price_profile(local: DataFrame) -> DataFrame:
    """Price quantiles of paid sends and how revenue moves with price."""
    p = num("price")
    agg = local.where(p > 0).groupBy("account").agg(
        *[quantile("price", q / 100).alias(f"p{q}") for q in (35, 50, 60, 80, 90)],
        correlation(p, num("rps")).alias("price_corr"),
    )
    return agg.withColumn(
        "price_mode", F.when(F.col("price_corr") > 0.2, "premium").when(F.col("price_corr") < -0.2, "value").otherwise("balanced")
    )


def decayed_template_stats(dm: DataFrame, as_of: str, half_life_days: float = 45) -> DataFrame:
    w = half_life(clock.whole_units("DAY", "sent_at", clock.moment(as_of)), half_life_days)
    return dm.groupBy("account_page", "template").agg(
        F.sum(num("sent") * w).alias("decayed_sent"), F.sum(num("purchased") * w).alias("decayed_bought")
    )


def account_priors(dm: DataFrame) -> DataFrame:
    return dm.groupBy("account_page").agg(ratio(F.sum("purchased"), F.sum("sent")).alias("mu_buy"))


def price_curve(dm: DataFrame, step: float = 10.0, nu: float = 200.0, z: float = 1.0) -> DataFrame:
    """Buy rate per price step, weekday and hour, shrunk to the account, with
    a normal lower bound on revenue per send."""
    paid = dm.where("kind = 'paid'").withColumn("price_q", F.ceil(num("price") / step) * step)
    curve = paid.groupBy("account_page", "dow", "hod", "price_q").agg(F.sum("sent").alias("sent"), F.sum("purchased").alias("bought"))
    c = salted_lookup(curve, account_priors(dm), ["account_page"])
    p = shrink("bought", "sent", "mu_buy", nu)
    se = F.sqrt(F.greatest(F.col("p_buy") * (1 - F.col("p_buy")), F.lit(0.0)) / (F.col("sent") + nu))
    return c.withColumn("p_buy", p).withColumn("rps_eb", F.col("price_q") * F.col("p_buy")).withColumn(
        "rps_lcb", F.col("price_q") * (F.col("p_buy") - z * se)
    )


def best_prices(curve: DataFrame) -> DataFrame:
    return top_k(curve, ["account_page", "dow", "hod"], [F.col("rps_lcb").desc(), F.col("price_q")], 1, "_r").drop("_r")


def slot_scorecard(dm: DataFrame, k: float = 50.0) -> DataFrame:
    """Slot value per weekday and hour, shrunk to the account's average."""
    s = dm.groupBy("account_page", "dow", "hod").agg(
        dsum("earnings").alias("rev"), F.sum("sent").alias("sent"), F.sum("purchased").alias("bought"),
        F.coalesce(ratio(F.sum(F.when(F.col("kind") == "free", F.col("earnings"))), F.sum(F.when(F.col("kind") == "free", F.col("sent")))), F.lit(0.0)).alias("rps_free"),
    )
    w = Window.partitionBy("account_page")  # at most 168 rows
    mean = ratio(F.sum("rev").over(w), F.sum("sent").over(w))
    buys = ratio(F.sum("bought").over(w), F.sum("sent").over(w))
    return s.select(
        "account_page", "dow", "hod", "sent", "rps_free",
        ((F.col("rev") + k * mean) / (F.col("sent") + k)).alias("slot_score"),
        ((F.col("bought") + k * buys) / (F.col("sent") + k)).alias("conversion_smooth"),
    )


def volume_profile(local: DataFrame) -> DataFrame:
    """Volume elasticity, within-day fatigue and the resulting boost."""
    paid = F.col("price") > 0
    daily = local.groupBy("account", "local_date").agg(
        F.count_if(paid).alias("n"), F.coalesce(F.sum(F.when(paid, F.col("earnings"))).cast("double"), F.lit(0.0)).alias("rev"),
        F.min_by(F.when(paid, num("earnings")), F.when(paid, F.struct("local_at", "message_id"))).alias("first_rev"),
        F.max_by(F.when(paid, num("earnings")), F.when(paid, F.struct("local_at", "message_id"))).alias("last_rev"),
    )
    n = num("n")
    twice = F.col("n") >= 2
    e = daily.groupBy("account").agg(
        F.avg(n).alias("avg_per_day"), F.percentile_approx(n, F.lit(0.9), F.lit(ACCURACY)).alias("q90_per_day"),
        correlation(n, "rev").alias("corr_volume_revenue"),
        F.when(F.var_pop(n) == 0, F.lit(0.0)).otherwise(F.try_divide(F.covar_pop(n, "rev"), F.var_pop(n))).alias("slope"),
        F.coalesce(ratio(F.avg(F.when(twice, F.col("last_rev"))), F.avg(F.when(twice, F.col("first_rev")))), F.lit(1.0)).alias("fatigue_ratio"),
    )
    s, f = F.col("slope"), F.col("fatigue_ratio")
    return e.withColumn(
        "volume_boost",
        F.when((s >= 12) & (f >= 0.70), 1.50).when((s >= 8) & (f >= 0.65), 1.30).when(s >= 4, 1.15)
        .when((s <= 1) | (f < 0.50), 0.90).otherwise(1.00),
    )


def assignee_kpis(facts: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    week = clock.within_days("sent_at", as_of, 7)
    per_account = facts.where(clock.within_days("sent_at", as_of, 28)).groupBy("account").agg(
        F.sum(F.when(week, F.col("earnings")).otherwise(F.lit(0))).alias("r7"), F.sum("earnings").alias("r28"),
        F.count_if(week).alias("m7"), F.count(F.lit(1)).alias("m28"),
    )
    return per_account.join(accounts.select("account", "assignee"), "account").groupBy("assignee").agg(
        F.sum("r7").alias("revenue_7d"), F.sum("r28").alias("revenue_28d"),
        F.sum("m7").alias("messages_7d"), F.sum("m28").alias("messages_28d"),
    )


def learning_signals(facts: DataFrame, as_of: str) -> DataFrame:
    """28-day totals with the last fortnight against the one before (an
    account missing from either half keeps its NULLs, as a full join would)."""
    cut = F.date_sub(clock.day(as_of), 14)
    late, early = F.col("sent_date") >= cut, F.col("sent_date") < cut
    a = facts.where(clock.within_days("sent_at", as_of, 28)).groupBy("account").agg(
        F.count(F.lit(1)).alias("sends"), dsum("earnings").alias("earnings"),
        quantile("price", 0.5).alias("p50_price"), (F.count_if(F.col("earnings") > 0) / F.count(F.lit(1))).alias("sell_rate"),
        F.count_if(late).alias("n1"), F.count_if(early).alias("n0"),
        F.sum(F.when(late, F.col("earnings"))).cast("double").alias("e1"),
        F.sum(F.when(early, F.col("earnings"))).cast("double").alias("e0"),
    )
    return a.select(
        "account", "sends", "earnings", ratio("earnings", "sends").alias("rps"), "p50_price", "sell_rate",
        ratio("e1", "n1").alias("rps_recent"), ratio("e0", "n0").alias("rps_previous"),
        ratio(F.col("e1") - F.col("e0"), "e0").alias("lift"),
    )


def knob_changes(signals: DataFrame) -> DataFrame:
    """Learned planning knobs: quota and hour pool by one, and a price bias."""
    lift, sell = F.col("lift"), F.col("sell_rate")
    return signals.select(
        "account",
        F.when(lift >= 0.15, 1).when(lift <= -0.15, -1).otherwise(0).alias("quota_step"),
        F.when(sell >= 0.20, 1).when(sell < 0.08, -1).otherwise(0).alias("hour_pool_step"),
        F.when((lift >= 0.15) & (sell >= 0.20), "up").when(lift <= -0.15, "down").otherwise("hold").alias("price_bias"),
    )
