"""Alerts, volume, timing and revenue advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.functions import clock
from outpulse.functions.numeric import dsum, ladder, num, ratio, strict_greatest, strict_least, whole
from outpulse.operators.joins import overall, packed_lookup, salted_lookup
from outpulse.operators.ordered import lagged
from outpulse.operators.ranking import top_k, with_ranks
from outpulse.plans.semantic import quantile
from outpulse.session import stabilise


def present(*pairs: tuple[Column, object]) -> Column:
    """Array of the values whose condition holds."""
    return F.filter(F.array(*[F.when(c, v if isinstance(v, Column) else F.lit(v)) for c, v in pairs]), lambda x: x.isNotNull())


def daily_totals(facts: DataFrame) -> DataFrame:
    return facts.groupBy("account", "sent_date").agg(
        dsum("earnings").alias("revenue"), F.sum("sent").alias("sent"), F.sum("purchased").alias("purchased"),
        F.countDistinct("template").alias("templates"), F.avg(ratio("purchased", "sent")).alias("mean_conversion"),
        F.max("sent_at").alias("latest_at"),
    )


def performance_alerts(facts: DataFrame, as_of: str, min_days: int = 10) -> DataFrame:
    """The last seven days of each account against the 23 days before them."""
    start = F.expr(f"timestamp_ntz'{as_of}' - interval 7 days")
    month = facts.where(clock.within_days("sent_at", as_of, 30))
    old = daily_totals(month.where(F.col("sent_at") < start)).withColumn("conversion", ratio("purchased", "sent"))
    base = old.groupBy("account").agg(
        F.avg("revenue").alias("exp_revenue"), F.stddev("revenue").alias("sd_revenue"),
        quantile("revenue", 0.25).alias("p25"), quantile("revenue", 0.75).alias("p75"), quantile("revenue", 0.9).alias("p90"),
        F.avg("conversion").alias("exp_conversion"), F.stddev("conversion").alias("sd_conversion"), quantile("conversion", 0.25).alias("conv_p25"),
        F.avg("sent").alias("exp_sent"), F.stddev("sent").alias("sd_sent"), F.avg("templates").alias("exp_templates"), F.count(F.lit(1)).alias("days"),
    ).where(F.col("days") >= min_days)
    now = daily_totals(month.where(F.col("sent_at") >= start))
    j = now.join(base, "account").withColumns({
        "revenue_z": ratio(F.col("revenue") - F.col("exp_revenue"), "sd_revenue"),
        "conversion_z": ratio(F.col("mean_conversion") - F.col("exp_conversion"), "sd_conversion"),
        "volume_z": ratio(F.col("sent") - F.col("exp_sent"), "sd_sent"),
    })
    stale = clock.whole_units("HOUR", "latest_at", clock.moment(as_of)) > 8
    low_conv, low_div = F.col("mean_conversion") < F.col("conv_p25"), F.col("templates") < F.col("exp_templates") * 0.7
    low_vol = F.col("sent") < F.col("exp_sent") * 0.8

    def points(cond: Column, n: int) -> Column:
        return F.when(cond, n).otherwise(0)

    return j.select(
        "account", "sent_date", "revenue", "exp_revenue", "revenue_z", "mean_conversion", "conversion_z", "volume_z", "templates", "exp_templates", "latest_at",
        F.when((F.col("revenue") < F.col("p25")) & (F.col("revenue_z") < -2.0), "CRITICAL_LOW")
        .when(F.col("revenue") < F.col("exp_revenue") - F.col("sd_revenue"), "WARNING").when(F.col("revenue") > F.col("p90"), "EXCEEDING")
        .when(F.col("revenue") > F.col("p75"), "GOOD").otherwise("NORMAL").alias("status"),
        present((low_conv, "low_conversion"), (low_div, "low_diversity"), (low_vol, "low_volume"), (stale, "stale_activity"),
                (F.col("revenue_z") < -1.5, "revenue_concern"), (F.col("conversion_z") < -1.5, "conversion_concern")).alias("issues"),
        F.when(F.col("revenue") < F.col("p25"), "deploy_winners").when(low_conv, "improve_conversion").when(low_div, "rotate_more")
        .when(low_vol, "raise_volume").when(stale, "check_activity").otherwise("monitor").alias("action"),
        strict_least(F.lit(100), strict_greatest(F.lit(0), 50 - whole(F.col("revenue_z") * 15) + points(low_conv, 20) + points(low_div, 15) + points(stale, 25))).alias("severity"),
    )


def recovery_candidates(alerts: DataFrame, facts: DataFrame, cooldowns: DataFrame, engagement: DataFrame, as_of: str, k: int = 10) -> DataFrame:
    """For every account in trouble today: proven templates that rested lately."""
    last_day = F.date_sub(clock.day(as_of), 1)
    target = alerts.where((F.col("sent_date") == last_day) & (F.col("status").isin("CRITICAL_LOW", "WARNING") | (F.col("severity") > 60))).select("account", "status", "severity")
    week = F.expr(f"timestamp_ntz'{as_of}' - interval 7 days")
    conv = ratio("purchased", "sent")
    mine = salted_lookup(facts.where(clock.within_days("sent_at", as_of, 90)), target, ["account"], "inner")
    h = mine.groupBy("account", "template", "status", "severity").agg(
        F.avg(F.when(F.col("sent_at") < week, conv)).alias("old_conversion"), F.avg(F.when(F.col("sent_at") < week, num("earnings"))).alias("avg_earnings"),
        F.count_if(F.col("sent_at") < week).alias("old_uses"), F.count_if(F.col("sent_at") >= week).alias("recent_uses"),
    ).where((F.col("old_conversion") > 0.05) & (F.col("old_uses") >= 2) & (F.col("recent_uses") < 2))
    j = h.join(cooldowns.select("account", "template", "available_after", "override_suggested"), ["account", "template"], "left")
    j = salted_lookup(j, engagement.select("template", "engagement"), ["template"])
    score = (
        F.col("old_conversion") * 0.4 + F.col("avg_earnings") / 50 * 0.3 + F.least(F.lit(1.0), F.col("old_uses") / 10) * 0.2
        + F.coalesce("engagement", F.lit(0.5)) * 0.1
    )
    kind = F.when(F.col("severity") >= 80, "EMERGENCY_RECOVERY").when(F.col("status") == "CRITICAL_LOW", "AGGRESSIVE_RECOVERY").otherwise("PROACTIVE_ADJUSTMENT")
    return top_k(j.withColumns({"recovery_score": score, "kind": kind}), ["account"], [F.col("recovery_score").desc(), F.col("template")], k)


def intervention_log(candidates: DataFrame, minimum: float = 0.3) -> DataFrame:
    return candidates.where(F.col("recovery_score") > minimum).groupBy("account", "kind", "severity").agg(
        F.sort_array(F.collect_list(F.struct("rank", "template"))).alias("c"),  # at most ten per account
        F.count(F.lit(1)).alias("winners"), F.avg("old_conversion").alias("avg_conversion"),
    ).select("account", "kind", "severity", "winners", "avg_conversion", F.transform("c", lambda x: x.template).alias("templates"))


def system_health(facts: DataFrame, cooldowns: DataFrame, alerts: DataFrame, as_of: str) -> DataFrame:
    """One row: activity of the last day, stock of copy, alerts, three scores."""
    act = overall(
        facts.where(clock.within_days("sent_at", as_of, 1)), accounts=F.countDistinct("account"), messages=F.count(F.lit(1)),
        earnings=dsum("earnings"), conversion=F.avg(ratio("purchased", "sent")), templates=F.countDistinct("template"),
    )
    al = overall(
        alerts.where(F.col("sent_date") == F.date_sub(clock.day(as_of), 1)), critical=F.count_if(F.col("status") == "CRITICAL_LOW"),
        warning=F.count_if(F.col("status") == "WARNING"), severity=F.avg("severity"),
    )
    stock = cooldowns.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("available_after") <= clock.moment(as_of)).alias("ready"),
        F.count_if(F.col("fatigue") >= 0.8).alias("burnt_out"), F.count_if(F.col("performance_tier") == "ELITE").alias("elite"), F.avg("cooldown_days").alias("avg_cooldown"),
    )
    s = stock.withColumns({**{f"day_{k}": v for k, v in act.items()}, **{f"alerts_{k}": v for k, v in al.items()}})
    return s.withColumns({
        "conversion_score": F.when(F.col("day_accounts") == 0, 0).when(F.col("day_conversion") < 0.02, 30).when(F.col("day_conversion") < 0.05, 60)
        .when(F.col("day_conversion") < 0.08, 80).otherwise(95),
        "content_score": F.when(F.col("ready") < 100, 20).when(F.col("ready") < 500, 60).when(F.col("ready") < 1000, 80).otherwise(95),
        "alert_score": F.when(F.col("alerts_critical") > 5, 10).when(F.col("alerts_critical") > 2, 40).when(F.col("alerts_warning") > 10, 60)
        .when(F.col("alerts_severity") > 60, 70).otherwise(90),
    })


def volume_advice(facts: DataFrame, accounts: DataFrame, patterns: DataFrame, as_of: str) -> DataFrame:
    """Recommended daily sends per account: base x trend x stability x coverage."""
    recent = clock.within_days("sent_at", as_of, 10)
    c = ratio("purchased", "sent")
    perf = facts.where(clock.within_days("sent_at", as_of, 90) & (F.col("sent") > 0)).groupBy("account").agg(
        F.avg(c).alias("conversion"), F.avg(ratio("earnings", "sent")).alias("rps"), F.count(F.lit(1)).alias("sends"), F.stddev(c).alias("volatility"),
        F.avg(F.when(recent, c)).alias("new_conv"), F.avg(F.when(~recent, c)).alias("old_conv"),
    )
    a = accounts.select("account", "account_page", "tier", "page_state", "active_fans", "renew_on_pct", "daily_quota")
    j = a.join(perf, "account", "left").join(patterns.select("account", "volume_tier", "coverage"), "account", "left")
    j = j.withColumns({
        "conversion": F.coalesce("conversion", F.lit(0.0)), "rps": F.coalesce("rps", F.lit(0.0)), "sends": F.coalesce("sends", F.lit(0)),
        "volatility": F.coalesce("volatility", F.lit(1.0)), "volume_tier": F.coalesce("volume_tier", F.lit("MINIMAL_VOLUME")),
        "coverage": F.coalesce("coverage", F.lit(0.0)), "trend_ratio": ratio(F.coalesce("new_conv", F.lit(0.0)), F.coalesce("old_conv", F.lit(0.0))),
    })
    top, mid = F.col("tier") == "high", F.col("tier") == "medium"
    conv, fans = F.col("conversion"), F.col("active_fans")
    base = (
        F.when(top & (conv > 0.15) & (fans > 500) & (F.col("volume_tier") == "HIGH_VOLUME"), 10).when(top & (conv > 0.12) & (fans > 200), 8)
        .when((F.col("page_state") == "grow") & (conv > 0.08), 6).when(mid & (conv > 0.10) & F.col("volume_tier").isin("MEDIUM_VOLUME", "HIGH_VOLUME"), 5)
        .when(mid & (conv > 0.08), 4).when((F.col("page_state") == "retain") & (F.col("renew_on_pct") < 0.25), 3)
        .when((F.col("sends") < 50) | (conv < 0.05), 2).when(top, 6).when(mid, 4).otherwise(3)
    )
    t, v, s = F.col("trend_ratio"), F.col("volatility"), F.col("coverage")
    j = j.withColumns({
        "base_volume": base,
        "trend_mult": F.when(t > 1.2, 1.2).when(t > 1.1, 1.1).when(t < 0.8, 0.8).when(t < 0.9, 0.9).otherwise(1.0),
        "stability_mult": F.when(v < 0.05, 1.1).when(v < 0.10, 1.05).when(v > 0.30, 0.9).when(v > 0.20, 0.95).otherwise(1.0),
        "coverage_mult": F.when(s > 0.5, 1.1).when(s > 0.3, 1.05).when(s < 0.1, 0.9).otherwise(1.0),
    })
    raw = F.col("base_volume") * F.col("trend_mult") * F.col("stability_mult") * F.col("coverage_mult")
    j = j.withColumn("recommended", F.greatest(F.lit(2), F.least(F.lit(12), whole(raw))))
    return j.withColumns({
        "change": F.col("recommended") - F.col("daily_quota"),
        "band": ladder("recommended", (8, "high"), (6, "medium_high"), (4, "standard"), (3, "conservative"), default="minimal"),
        "confidence": F.when((F.col("sends") >= 100) & (v < 0.15), "HIGH").when((F.col("sends") >= 50) & (v < 0.25), "MEDIUM")
        .when(F.col("sends") >= 20, "LOW").otherwise("VERY_LOW"),
    })


def weekday_volume(facts: DataFrame, advice: DataFrame, as_of: str) -> DataFrame:
    """Volume advice per weekday, scaled by how the day converts."""
    c = facts.where(clock.within_days("sent_at", as_of, 90) & (F.col("sent") > 0)).groupBy("account", clock.sunday_based("sent_at").alias("weekday")).agg(
        F.avg(ratio("purchased", "sent")).alias("conv"), F.count(F.lit(1)).alias("sends"))
    c = c.withColumn("day_ratio", ratio("conv", F.avg("conv").over(Window.partitionBy("account"))))  # seven rows
    j = packed_lookup(advice.select("account", "recommended", "confidence"), c, ["account"], ["weekday"], {"weekday": F.sequence(F.lit(1), F.lit(7))})
    r = F.col("day_ratio")
    mult = F.when(r > 1.3, 1.4).when(r > 1.15, 1.2).when(r > 1.05, 1.1).when(r < 0.7, 0.7).when(r < 0.85, 0.85).otherwise(1.0)
    return j.withColumn("weekday_volume", F.greatest(F.lit(1), F.least(F.lit(15), whole(F.col("recommended") * mult)))).withColumns({
        "sends": F.coalesce("sends", F.lit(0)), "adjustment": F.col("weekday_volume") - F.col("recommended"),
        "note": F.when(r > 1.3, "strong").when(r > 1.15, "good").when(r > 1.05, "above_average").when(r < 0.7, "weak").when(r < 0.85, "below_average")
        .when(F.coalesce("sends", F.lit(0)) < 5, "limited_data").otherwise("average"),
    })


def tiered_volume(dm: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """28-day volume tiers with a send range, sensitivity and projection."""
    daily = dm.where("sent > 0").groupBy("account_page", F.to_date("local_at").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("sent").alias("sent"), F.sum("purchased").alias("bought"), dsum("earnings").alias("rev"))
    c, r, n = ratio("bought", "sent"), ratio("rev", "sent"), F.col("n")
    m = daily.groupBy("account_page").agg(
        F.avg(c).alias("conversion"), F.sum("sent").alias("sent"), F.sum("rev").alias("revenue"), F.count(F.lit(1)).alias("active_days"),
        F.avg("n").alias("avg_sends"), F.stddev("n").alias("send_sd"), F.avg(F.when(n <= 3, r)).alias("rps_low"),
        F.avg(F.when(n.between(4, 7), r)).alias("rps_mid"), F.avg(F.when(n >= 8, r)).alias("rps_high"),
    )
    m = m.join(overrides.select("account_page", "tier_override"), "account_page", "left") if overrides is not None else m.withColumn("tier_override", F.lit(None).cast("string"))
    conv, rev = F.col("conversion"), F.col("revenue")
    m = m.withColumns({
        "score": F.least(F.lit(100.0), F.greatest(F.lit(0.0), conv * 500 + rev / 100 + F.when(F.col("avg_sends") > 5, 25).otherwise(0))),
        "tier": F.coalesce("tier_override", F.when((conv >= 0.15) & (rev >= 2000), "high_volume").when((conv >= 0.10) & (rev >= 800), "standard")
                           .when((conv >= 0.05) & (rev >= 200), "conservative").otherwise("minimal")),
    })

    def rng(lo, hi, best) -> Column:
        return F.struct(F.lit(lo).alias("min_sends"), F.lit(hi).alias("max_sends"), F.lit(best).alias("optimal"))

    s = F.col("score")
    ranges = (
        F.when(F.col("tier") == "high_volume", F.when(s >= 80, rng(10, 12, 11)).when(s >= 60, rng(8, 10, 9)).otherwise(rng(6, 8, 7)))
        .when(F.col("tier") == "standard", F.when(s >= 70, rng(6, 8, 7)).when(s >= 50, rng(4, 6, 5)).otherwise(rng(3, 5, 4)))
        .when(F.col("tier") == "conservative", F.when(s >= 60, rng(4, 5, 4)).when(s >= 40, rng(3, 4, 3)).otherwise(rng(2, 3, 2)))
        .otherwise(rng(2, 3, 2))
    )
    m = m.withColumn("range", ranges)
    return m.select(
        "account_page", "tier", "score", "conversion", "revenue", "range",
        F.when(F.col("rps_high") > F.col("rps_mid") * 1.1, "VOLUME_BOOST").when(F.col("rps_low") > F.col("rps_mid") * 1.1, "VOLUME_SENSITIVE").otherwise("VOLUME_NEUTRAL").alias("sensitivity"),
        F.when(conv < 0.05, "LOW_CONVERSION").when(F.col("sent") < 30, "INSUFFICIENT_DATA").when(F.col("send_sd") > F.col("avg_sends"), "INCONSISTENT_VOLUME").otherwise("HEALTHY").alias("quality"),
        (F.col("range.optimal") * F.coalesce("rps_mid", "rps_low", F.lit(5.0)) * 30).alias("projected_month"),
    )


def schedule_with_volume(plan: DataFrame, tiers: DataFrame, scorecard: DataFrame) -> DataFrame:
    """First planned day of each account with its slots graded by volume tier."""
    w = Window.partitionBy("account_page", "date_local")
    j = salted_lookup(plan.select("account_page", "date_local", "dow", "hod", "slot_rank", "price"), tiers, ["account_page"])
    j = packed_lookup(j, scorecard.select("account_page", "dow", "hod", "slot_score", "conversion_smooth"), ["account_page"], ["dow", "hod"])
    j = j.withColumn("r", F.row_number().over(w.orderBy(F.col("slot_score").desc_nulls_last(), "slot_rank")))
    pri = F.when(F.col("r") <= F.coalesce("range.optimal", F.lit(4)), "RECOMMENDED").when(F.col("r") <= F.coalesce("range.max_sends", F.lit(6)), "OPTIONAL").otherwise("EXCESS")
    return j.withColumns({
        "priority": pri, "projected": F.col("price") * F.coalesce("conversion_smooth", F.lit(0.08)),
    }).withColumn(
        "guidance",
        F.when(F.col("quality") == "LOW_CONVERSION", "improve_copy").when(F.col("quality") == "INSUFFICIENT_DATA", "gather_data")
        .when(F.col("sensitivity") == "VOLUME_SENSITIVE", "reduce_volume").when(F.col("sensitivity") == "VOLUME_BOOST", "increase_volume")
        .when(F.col("priority") == "EXCESS", "consider_skipping").otherwise("keep"),
    )


def timing_regularity(facts: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """How machine-like an account's send times look, on two 0..100 scales."""
    s = facts.where(clock.within_days("sent_at", as_of, days)).select(
        "account", "sent_at", "message_id", "sent_date", F.hour("sent_at").alias("hod"), F.minute("sent_at").alias("minute"))
    s = lagged(s, ["account"], ["sent_at", "message_id"], ["hod", "minute", "sent_date"], 3)
    h, h1 = F.col("hod"), F.coalesce("hod_lag1", "hod")
    h2 = F.coalesce(F.col("hod_lag2"), h1)
    d1, d2 = F.abs(h - h1), F.abs(h1 - h2)
    exact = F.coalesce((h == F.col("hod_lag1")) & (F.abs(F.col("minute") - F.col("minute_lag1")) <= 5), F.lit(False))
    streak = F.coalesce((h == F.col("hod_lag1")) & (F.datediff("sent_date", "sent_date_lag1") == 1), F.lit(False))
    cells = s.groupBy("account", "sent_date", "hod", F.floor(F.col("minute") / 15).alias("quarter")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(d1 <= 1).alias("close"), F.count_if((d1 <= 1) & (d2 <= 1)).alias("seq"),
        F.count_if(exact).alias("exact"), F.count_if(streak).alias("streak"),
    )  # at most days x 96 rows per account
    n = F.col("n")
    acct = cells.groupBy("account").agg(
        F.sum("n").alias("sends"), F.countDistinct("sent_date").alias("active_days"), F.countDistinct("hod").alias("hours_used"),
        F.countDistinct("hod", "quarter").alias("windows_used"), F.countDistinct(F.dayofweek("sent_date")).alias("weekdays_used"),
        F.sum("close").alias("close_times"), F.sum("seq").alias("robotic_seq"), F.sum("exact").alias("exact_repeats"), F.sum("streak").alias("same_hour_days"),
        F.sum(n * F.col("hod")).alias("_h"), F.sum(n * F.col("hod") * F.col("hod")).alias("_hh"),
        *[F.sum(F.when(F.col("hod").between(lo, hi), n).otherwise(0)).alias(name) for name, lo, hi in
          (("morning", 6, 11), ("afternoon", 12, 17), ("evening", 18, 23), ("night", 0, 5))],
    )
    mode = cells.groupBy("account", "hod").agg(F.sum("n").alias("n")).groupBy("account").agg(
        F.max_by("hod", F.struct("n", -F.col("hod"))).alias("common_hour"), F.max("n").alias("common_count"))
    per_day = cells.groupBy("account", "sent_date").agg(F.sum("n").alias("n")).groupBy("account").agg(
        ratio(F.sum(n * n), F.sum("n")).alias("avg_per_day"), F.max("n").alias("max_per_day"), F.sum(F.when(n > 3, n).otherwise(0)).alias("burst"))
    a = acct.join(mode, "account").join(per_day, "account").withColumns({
        "hour_sd": F.when(F.col("sends") > 1, F.sqrt((F.col("_hh") - F.col("_h") * F.col("_h") / F.col("sends")) / (F.col("sends") - 1))),
        "common_ratio": ratio("common_count", "sends"),
    })

    def pts(cond: Column, p) -> Column:
        return F.when(cond, p).otherwise(0)

    dominant = F.greatest("morning", "afternoon", "evening") > 0.8 * F.col("sends")
    robotic = (
        pts(F.col("hours_used") <= 2, 25) + F.col("exact_repeats") * 5 + F.least(F.col("close_times") * 3, F.lit(20)) + F.col("robotic_seq") * 8
        + F.col("same_hour_days") * 4 + F.when(F.col("common_ratio") > 0.6, 15).when(F.col("common_ratio") > 0.4, 8).otherwise(0)
        + pts(F.col("hour_sd") < 2, 10) + pts(F.col("windows_used") <= 3, 8)
    )
    engage = pts(dominant, 20) + pts((F.col("weekdays_used") <= 2) & (F.col("active_days") > 5), 15) + pts(F.col("burst") > F.col("active_days") * 0.5, 10) + pts(F.col("hour_sd") < 1.5, 12)
    a = a.withColumns({"robotic_risk": F.least(F.lit(100), robotic), "engagement_risk": F.least(F.lit(100), engage)})
    a = a.withColumn("risk", F.greatest("robotic_risk", "engagement_risk"))
    return a.withColumn("risk_level", ladder("risk", (70, "CRITICAL"), (50, "HIGH"), (30, "MEDIUM"), (15, "LOW"), default="MINIMAL")).drop("_h", "_hh")


SEVERITY_POINTS = {"CRITICAL": 100, "HIGH": 75, "MEDIUM": 50, "LOW": 25}


def timing_alerts(regularity: DataFrame) -> DataFrame:
    """Ten timing rules, one row per rule broken."""
    c = F.col
    rules = (
        ("ROBOTIC_TIMING", "CRITICAL", c("robotic_seq") >= 3), ("EXACT_REPEATS", "HIGH", c("exact_repeats") >= 2),
        ("HOUR_DOMINANCE", "MEDIUM", c("common_ratio") > 0.5), ("CONSECUTIVE_SAME_HOUR", "HIGH", c("same_hour_days") >= 3),
        ("LIMITED_TIME_DIVERSITY", "HIGH", (c("hours_used") <= 2) & (c("sends") >= 8)), ("LOW_TIME_VARIANCE", "MEDIUM", (c("hour_sd") < 2) & (c("sends") >= 6)),
        ("NARROW_WINDOWS", "MEDIUM", (c("windows_used") <= 3) & (c("sends") >= 8)),
        ("TIME_PERIOD_DOMINANCE", "MEDIUM", F.greatest("morning", "afternoon", "evening") > 0.8 * c("sends")),
        ("DOW_MONOTONY", "LOW", (c("weekdays_used") <= 2) & (c("active_days") >= 6)),
        ("EXCESSIVE_BURSTING", "MEDIUM", (c("burst") > c("active_days") * 0.6) & (c("max_per_day") > 4)),
    )
    found = present(*[(cond, F.struct(F.lit(n).alias("alert"), F.lit(s).alias("severity"), F.lit(SEVERITY_POINTS[s]).alias("points"))) for n, s, cond in rules])
    r = regularity.where(c("sends") >= 3).select("account", "risk_level", "risk", F.explode(found).alias("a"))
    return r.select("account", "risk_level", "risk", "a.alert", "a.severity", (c("a.points") + c("risk") * 0.3).alias("priority"))


def timing_suggestions(regularity: DataFrame, facts: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Better and unused hours for accounts whose timing looks regular."""
    active = facts.where(clock.within_days("sent_at", as_of, 14)).groupBy("account").agg(F.array_sort(F.collect_set(F.hour("sent_at"))).alias("active_hours"))
    perf = facts.where(clock.within_days("sent_at", as_of, 90) & (F.col("sent") > 0)).groupBy("account", F.hour("sent_at").alias("hod")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(ratio("purchased", "sent")).alias("conv"), F.avg(ratio("earnings", "sent")).alias("rps"))
    side = accounts.where("is_active").select("account", "min_hour", "max_hour").join(active, "account", "left")
    good = perf.join(side, "account").where(
        F.col("hod").between(F.col("min_hour"), F.col("max_hour")) & (F.col("n") >= 2)
        & (~F.coalesce(F.array_contains("active_hours", F.col("hod")), F.lit(False)) | (F.col("conv") > 0.08)))
    best = top_k(good, ["account"], [F.col("conv").desc(), F.col("rps").desc(), F.col("hod")], 6).groupBy("account").agg(
        F.sort_array(F.collect_list(F.struct("rank", "hod"))).alias("b"))
    r = regularity.where(F.col("risk") > 10).select("account", "risk_level", "risk", "common_hour", "common_ratio", "hours_used")
    j = r.join(side, "account").join(best, "account", "left")
    all_hours = F.sequence(F.col("min_hour"), F.col("max_hour"))
    free = F.array_except(all_hours, F.transform(F.coalesce("active_hours", F.array().cast("array<int>")), lambda x: x.cast("long")))
    unused = F.slice(F.transform(F.array_sort(F.transform(free, lambda h: F.struct(F.abs(h - 14).alias("g"), h.alias("h")))), lambda x: x.h), 1, 8)
    lvl = F.col("risk_level")
    return j.select(
        "account", "risk_level", "risk", "common_hour", "active_hours", F.transform(F.coalesce("b", F.array().cast("array<struct<rank:int,hod:int>>")), lambda x: x.hod).alias("suggested_hours"),
        unused.alias("unused_hours"),
        F.when(lvl.isin("CRITICAL", "HIGH") & (F.col("hours_used") <= 2), "EMERGENCY").when((lvl == "HIGH") & (F.col("common_ratio") > 0.5), "HIGH_PRIORITY")
        .when(lvl == "MEDIUM", "MEDIUM_PRIORITY").when(lvl == "LOW", "LOW_PRIORITY").otherwise("GOOD").alias("strategy"),
    )


def revenue_projections(slots: DataFrame, dm: DataFrame, curve: DataFrame, advice: DataFrame, ranked: DataFrame) -> DataFrame:
    """Expected revenue per recommended slot against history, other prices and
    better copy."""
    rps = ratio("earnings", "sent")
    hist = dm.groupBy("account_page", "dow", "hod").agg(
        F.count(F.lit(1)).alias("n"), F.avg(num("price")).alias("hist_price"), F.avg(num("earnings")).alias("hist_revenue"),
        F.stddev(num("earnings")).alias("volatility"), F.avg(ratio("purchased", "sent")).alias("hist_conversion"), F.avg(rps).alias("hist_rps"),
    ).where(F.col("n") >= 2)
    alt = top_k(curve, ["account_page", "dow", "hod"], [F.col("rps_eb").desc(), F.col("price_q")], 1, "_r").select(
        "account_page", "dow", "hod", F.col("price_q").alias("alt_price"), F.col("rps_eb").alias("alt_revenue"))
    copy = top_k(ranked, ["account_page", "slot_at"], [F.col("score").desc(), F.col("template")], 1, "_r").select(
        "account_page", "slot_at", F.col("rps_eb").alias("copy_revenue"))
    page = ["account_page"]  # every lookup is by page, so the slots are dealt once
    j = slots.select("account", "account_page", "slot_at", "dow", "hod", "kind", "price", "p_buy")
    j = salted_lookup(j, advice.select("account_page", "recommended", "tier", "page_state"), page)
    j = packed_lookup(packed_lookup(j, hist, page, ["dow", "hod"]), alt, page, ["dow", "hod"])
    j = packed_lookup(j, copy, page, ["slot_at"])
    j = j.withColumn("projected", F.col("price") * F.coalesce("p_buy", F.lit(0.08)))
    j = j.withColumns({
        "n": F.coalesce("n", F.lit(0)), "hist_revenue": F.coalesce("hist_revenue", F.lit(0.0)), "volatility": F.coalesce("volatility", F.lit(0.0)),
        "recommended": F.coalesce("recommended", F.lit(4)), "alt_revenue": F.coalesce("alt_revenue", "projected"), "copy_revenue": F.coalesce("copy_revenue", "projected"),
    })
    j = j.withColumns({
        "lift": F.col("projected") - F.col("hist_revenue"), "price_gain": F.col("alt_revenue") - F.col("projected"), "copy_gain": F.col("copy_revenue") - F.col("projected"),
        "day_projection": F.col("projected") * F.col("recommended"), "day_baseline": F.col("hist_revenue") * F.greatest(F.col("recommended"), F.lit(1)),
        "confidence": ladder("n", (10, "HIGH"), (5, "MEDIUM"), (2, "LOW"), default="VERY_LOW"),
        "risk": F.when(F.col("volatility") > F.col("projected") * 0.5, "HIGH_VOLATILITY").when(F.col("volatility") > F.col("projected") * 0.3, "MEDIUM_VOLATILITY").otherwise("STABLE"),
    })
    # Nine places: equal sums taken in another order must still tie.
    return j.withColumn("opportunity", F.round(F.col("lift") + F.col("price_gain") * 0.5 + F.col("copy_gain") * 0.3, 9))


def daily_impact(projections: DataFrame) -> DataFrame:
    a = projections.groupBy("account", "account_page", F.to_date("slot_at").alias("d"), "tier").agg(
        F.count(F.lit(1)).alias("slots"), F.sum("projected").alias("projected"), F.sum("day_baseline").alias("baseline"),
        F.sum(F.col("day_projection") - F.col("day_baseline")).alias("lift"), F.sum(F.greatest("price_gain", F.lit(0.0))).alias("price_gain"),
        F.sum(F.greatest("copy_gain", F.lit(0.0))).alias("copy_gain"), F.max("recommended").alias("volume"),
        F.count_if(F.col("confidence") == "HIGH").alias("sure"), F.count_if(F.col("risk") == "HIGH_VOLATILITY").alias("risky"), F.avg("opportunity").alias("avg_opportunity"),
    )
    gain = F.col("price_gain") + F.col("copy_gain")
    points = F.when(F.col("tier") == "high", 10).when(F.col("tier") == "medium", 5).otherwise(3)
    return a.withColumns({
        "lift_pct": ratio("lift", "baseline") * 100,
        "priority": F.col("lift") * 0.4 + gain * 0.3 + F.col("avg_opportunity") * F.col("slots") * 0.2 + points * 0.1,
        "advice": F.when((F.col("lift") > 50) & (F.col("sure") >= F.col("slots") * 0.7), "HIGH_IMPACT").when(gain > 30, "OPTIMIZATION")
        .when(F.col("risky") > F.col("slots") * 0.5, "CAUTION").when(F.col("lift") > 0, "POSITIVE").otherwise("STABLE"),
        "actions": present((F.col("price_gain") > 20, "review_pricing"), (F.col("copy_gain") > 15, "improve_copy"), (F.col("risky") >= 2, "watch_volatility"),
                           (F.col("slots") < F.col("volume"), "add_slots")),
    })


def opportunity_ranking(projections: DataFrame) -> DataFrame:
    """Slots ranked by adjusted opportunity: overall, per day and per account.
    The overall and daily ranks are counted in buckets, not sorted in one task."""
    raw = F.col("lift") * 0.4 + F.col("price_gain") * 0.3 + F.col("copy_gain") * 0.2 + F.col("projected") * F.when(F.col("tier") == "high", 1.2).when(F.col("tier") == "medium", 1.1).otherwise(1.0) * 0.1
    sure = F.when(F.col("confidence") == "HIGH", 1.0).when(F.col("confidence") == "MEDIUM", 0.8).when(F.col("confidence") == "LOW", 0.6).otherwise(0.4)
    calm = F.when(F.col("risk") == "HIGH_VOLATILITY", 0.7).when(F.col("risk") == "MEDIUM_VOLATILITY", 0.85).otherwise(1.0)
    p = projections.withColumns({"raw": raw}).where(F.col("raw") > 0).select(
        "account_page", "slot_at", F.to_date("slot_at").alias("d"), "raw", F.round(F.col("raw") * sure * calm, 9).alias("adjusted"), "price_gain", "copy_gain")
    r = with_ranks(p, [("all", [], "adjusted"), ("day", ["d"], "adjusted")], descending=True)
    mine = Window.partitionBy("account_page").orderBy(F.col("adjusted").desc(), "slot_at")  # at most 24 rows
    r = r.withColumn("account_rank", F.row_number().over(mine))
    return r.withColumn(
        "priority",
        F.when(F.col("all_rank") <= 10, "TOP_PRIORITY").when(F.col("account_rank") == 1, "ACCOUNT_PRIORITY").when(F.col("price_gain") > 20, "PRICING_FOCUS")
        .when(F.col("copy_gain") > 15, "COPY_FOCUS").when(F.col("raw") > 10, "GOOD_OPPORTUNITY").otherwise("STANDARD"),
    )


def enhanced_slots(slots: DataFrame, advice: DataFrame, regularity: DataFrame, alerts: DataFrame, projections: DataFrame) -> DataFrame:
    """Slot scores multiplied by volume, timing and revenue findings."""
    top = top_k(alerts, ["account"], [F.col("priority").desc(), F.col("alert")], 3).groupBy("account").agg(F.sort_array(F.collect_list(F.struct("rank", "alert"))).alias("al"))
    j = slots.select("account", "account_page", "slot_at", "hod", "kind", "price", "slot_score")
    side = advice.select("account", "recommended", F.col("confidence").alias("volume_confidence")).join(
        regularity.select("account", F.col("risk").alias("timing_risk"), "common_hour", "common_ratio"), "account", "left").join(top, "account", "left")
    j = salted_lookup(j, side, ["account"])
    j = packed_lookup(j, projections.select("account_page", "slot_at", "projected", "lift", "price_gain", "copy_gain", "opportunity"), ["account_page"], ["slot_at"])
    v, o = F.col("recommended"), F.col("opportunity")
    j = j.withColumns({
        "volume_mult": F.when(v >= 8, 1.2).when(v >= 6, 1.1).when(v <= 3, 0.9).otherwise(1.0),
        "timing_mult": F.when((F.col("common_hour") == F.col("hod")) & (F.col("common_ratio") > 0.4), 0.7)
        .when((F.col("timing_risk") > 50) & (F.col("common_hour") == F.col("hod")), 0.8).when(F.col("timing_risk") < 20, 1.1).otherwise(1.0),
        "revenue_mult": F.when(o > 50, 1.3).when(o > 25, 1.15).when(o > 10, 1.05).when(F.col("lift") < -5, 0.8).otherwise(1.0),
    })
    j = j.withColumn("impact", F.col("volume_mult") * F.col("timing_mult") * F.col("revenue_mult") - 1).withColumn("enhanced", F.round(F.col("slot_score") * (F.col("impact") + 1), 9))
    w = Window.partitionBy("account_page", F.to_date("slot_at")).orderBy(F.col("enhanced").desc_nulls_last(), "slot_at")  # at most 24 rows
    j = j.withColumn("daily_rank", F.row_number().over(w)).withColumn("within_volume", F.col("daily_rank") <= F.coalesce("recommended", F.lit(4)))
    return j.withColumns({
        "priority": F.when(F.col("daily_rank") == 1, "TOP_PRIORITY").when(F.col("within_volume") & (F.col("impact") > 0.2), "HIGH_PRIORITY")
        .when(F.col("within_volume"), "RECOMMENDED").when(F.col("daily_rank") <= 8, "CONSIDER").otherwise("LOW_PRIORITY"),
        "actions": present((F.col("timing_risk") > 50, "vary_times"), (F.col("price_gain") > 20, "try_other_price"), (F.col("copy_gain") > 15, "try_other_copy"),
                           (F.col("volume_confidence") == "VERY_LOW", "low_volume_confidence")),
        "alerts": F.transform("al", lambda x: x.alert),
    }).drop("al")


def enhanced_plan(plan: DataFrame, advice: DataFrame, weekday: DataFrame, regularity: DataFrame, projections: DataFrame) -> DataFrame:
    """Weekly plan with volume, timing and revenue scores and a grade."""
    reg = regularity.select("account", F.col("risk").alias("timing_risk"), "common_hour", "common_ratio")
    side = advice.select("account", "recommended").join(reg, "account", "left")
    pr = projections.select("account_page", F.to_date("slot_at").alias("date_local"), F.hour("slot_at").alias("hod"), "lift", "opportunity")
    j = plan.select("account", "account_page", "date_local", "slot_rank", "hod", "price", F.dayofweek("date_local").alias("weekday"))
    # Dealt by page and by account only: what belongs to a day or an hour is a map of them.
    j = packed_lookup(j, pr, ["account_page"], ["date_local", "hod"])
    j = salted_lookup(j, side, ["account"])
    j = packed_lookup(j, weekday.select("account", "weekday", "weekday_volume"), ["account"], ["weekday"])
    limit = F.coalesce("weekday_volume", "recommended", F.lit(4))
    dominant = (F.col("common_hour") == F.col("hod")) & (F.col("common_ratio") > 0.4)
    risk = F.when(dominant, "HIGH_RISK").when(F.col("timing_risk") > 50, "MEDIUM_RISK").when(F.col("timing_risk") < 20, "LOW_RISK").otherwise("NORMAL")
    o = F.col("opportunity")
    j = j.withColumn("slot_risk", risk).withColumns({
        "volume_score": F.when(F.col("slot_rank") <= limit, 1.0).when(F.col("slot_rank") <= limit + 1, 0.8).otherwise(0.5),
        "timing_score": F.when(F.col("slot_risk") == "LOW_RISK", 1.0).when(F.col("slot_risk") == "NORMAL", 0.9).when(F.col("slot_risk") == "MEDIUM_RISK", 0.7).otherwise(0.4),
        "revenue_score": F.when(o > 50, 1.2).when(o > 25, 1.1).when(o > 10, 1.0).when(F.col("lift") < -5, 0.7).otherwise(0.9),
    })
    gain = F.when(o > 25, 1.0).when(o > 10, 0.9).when(F.col("lift") >= 0, 0.8).otherwise(0.6)
    j = j.withColumn("health", F.when(F.col("slot_rank") <= limit, 1.0).otherwise(0.7) * 0.4 + F.col("timing_score") * 0.3 + gain * 0.3)
    return j.withColumns({
        "grade": ladder(F.round("health", 6), (0.9, "EXCELLENT"), (0.8, "GOOD"), (0.7, "FAIR"), (0.6, "NEEDS_IMPROVEMENT"), default="POOR"),
        "actions": present((F.col("slot_risk") == "HIGH_RISK", "change_hour"), (F.col("volume_score") < 0.8, "remove_slot"), (o > 30, "optimise_revenue"), (F.col("lift") < -5, "underperforms")),
    })


def plan_dashboard(enhanced: DataFrame) -> DataFrame:
    """One row of plan health, with the fifty accounts that need most care."""
    p = enhanced.groupBy("account_page").agg(
        F.count_if(F.col("volume_score") < 0.8).alias("volume_issues"), F.count_if(F.col("slot_risk").isin("HIGH_RISK", "MEDIUM_RISK")).alias("timing_issues"),
        F.sum(F.coalesce("opportunity", F.lit(0.0))).alias("opportunity"), F.avg("health").alias("health"), F.count(F.lit(1)).alias("slots"),
        F.count_if(F.round("health", 6) < 0.7).alias("problem_slots"),
    )
    p = stabilise(p)  # one row per account, read twice
    worst = top_k(p.withColumn("one", F.lit(1)).withColumn("h", F.round("health", 9)), ["one"], [F.col("h"), F.round("opportunity", 6).desc(), F.col("account_page")], 50).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "account_page"))), lambda x: x.account_page).alias("worst"))
    s = p.agg(F.count(F.lit(1)).alias("accounts"), F.avg("health").alias("health"), F.sum("volume_issues").alias("volume_issues"), F.sum("timing_issues").alias("timing_issues"),
              F.sum("opportunity").alias("opportunity"), F.sum("problem_slots").alias("problem_slots"), F.sum("slots").alias("slots"))
    return s.withColumns({
        "worst": worst.scalar(),
        "status": F.when(F.col("health") < 0.7, "CRITICAL").when(F.col("timing_issues") > F.col("accounts") * 0.3, "TIMING").when(F.col("volume_issues") > F.col("accounts") * 0.2, "VOLUME")
        .when(F.col("opportunity") > 1000, "HIGH_OPPORTUNITY").when(F.col("health") > 0.85, "HEALTHY").otherwise("MODERATE"),
    })
