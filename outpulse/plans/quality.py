"""Dashboards, data-quality checks and plan QA."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.functions import clock, text
from outpulse.functions.numeric import dsum, ladder, num, ratio
from outpulse.operators.joins import overall, salted_lookup
from outpulse.operators.ranking import top_k, with_ranks
from outpulse.plans.advice import present
from outpulse.plans.ingest import parsed_reports
from outpulse.plans.semantic import ACCURACY, quantile


def revenue_overview(facts: DataFrame, as_of: str) -> DataFrame:
    d = facts.where(clock.day_within("sent_date", as_of, 90)).groupBy("sent_date").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("sent").alias("sent"), dsum("earnings").alias("revenue"), F.avg(num("price")).alias("avg_price"),
        ratio(F.sum("viewed"), F.sum("sent")).alias("view_rate"), ratio(F.sum("purchased"), F.sum("sent")).alias("purchase_rate"),
        ratio(dsum("earnings"), F.sum("purchased")).alias("order_value"))
    w = Window.orderBy("sent_date")  # at most 91 rows: one per day
    return d.withColumn("previous", F.lag("revenue").over(w)).withColumn("growth", ratio(F.col("revenue") - F.col("previous"), "previous"))


def assignee_performance(facts: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    per_account = facts.where(clock.day_within("sent_date", as_of, 30)).groupBy("account").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("sent").alias("sent"), F.sum("purchased").alias("bought"), F.sum("earnings").alias("rev"))
    a = per_account.join(accounts.select("account", "assignee"), "account", "left").groupBy(F.coalesce("assignee", F.lit("unassigned")).alias("assignee")).agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("messages").alias("messages"), num(F.sum("rev")).alias("revenue"),
        ratio(F.sum("bought"), F.sum("sent")).alias("conversion"), ratio(F.sum("rev"), F.sum("messages")).alias("per_message"), ratio(F.sum("rev"), F.count(F.lit(1))).alias("per_account"))
    r = with_ranks(a, [("revenue", [], "revenue"), ("conversion", [], "conversion"), ("efficiency", [], "per_message")], descending=True)
    return r.withColumn("score", F.col("revenue_rank") * 0.5 + F.col("conversion_rank") * 0.3 + F.col("efficiency_rank") * 0.2)


def account_leaderboard(facts: DataFrame, as_of: str) -> DataFrame:
    a = facts.where(clock.day_within("sent_date", as_of, 30)).groupBy("account").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("sent").alias("sent"), dsum("earnings").alias("revenue"), ratio(F.sum("purchased"), F.sum("sent")).alias("purchase_rate"),
        ratio(F.sum("earnings"), F.sum("sent")).alias("per_send"), F.max("sent_date").alias("last_active")).where(F.col("sent") > 10)
    r = with_ranks(a, [("revenue", [], "revenue"), ("conversion", [], "purchase_rate"), ("efficiency", [], "per_send")], descending=True)
    idle, p, s = clock.days_between(clock.day(as_of), "last_active"), F.col("purchase_rate"), F.col("per_send")
    return r.withColumn("tier", F.when(idle > 7, "INACTIVE").when((p >= 0.05) & (s >= 0.10), "EXCELLENT").when((p >= 0.03) & (s >= 0.05), "GOOD").when(p >= 0.01, "FAIR").otherwise("POOR"))


def prediction_accuracy(predictions: DataFrame, facts: DataFrame) -> DataFrame:
    """Predicted buy rate per account page x template against what happened."""
    p = predictions.groupBy("account", "template").agg(F.avg("p_buy").alias("predicted"), F.count(F.lit(1)).alias("recommended"))
    act = facts.groupBy("account", "template").agg(F.sum("sent").alias("sent"), F.sum("purchased").alias("bought")).where("sent > 0")
    err = F.abs(F.col("predicted") - F.col("actual"))
    return p.join(act, ["account", "template"]).withColumn("actual", ratio("bought", "sent")).withColumn("error", err).withColumn(
        "accuracy", F.when(F.col("error") <= 0.01, "EXCELLENT").when(F.col("error") <= 0.02, "GOOD").when(F.col("error") <= 0.03, "FAIR").otherwise("POOR"))


def executive_summary(facts: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """This period against the one before it, in one row."""
    now, before = clock.within_days("sent_at", as_of, days), clock.within_days("sent_at", as_of, 2 * days) & ~clock.within_days("sent_at", as_of, days)

    def s(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, F.col(c))).cast("double")

    a = facts.where(clock.within_days("sent_at", as_of, 2 * days)).agg(
        F.countDistinct(F.when(now, F.col("account"))).alias("accounts"), F.countDistinct(F.when(now, F.col("sent_date"))).alias("active_days"), F.count_if(now).alias("messages"),
        s(now, "earnings").alias("revenue"), ratio(s(now, "purchased"), s(now, "sent")).alias("conversion"), s(before, "earnings").alias("previous_revenue"),
        ratio(s(before, "purchased"), s(before, "sent")).alias("previous_conversion"))
    return a.select("*", ratio("revenue", "accounts").alias("per_account"), ratio("revenue", "messages").alias("per_message"),
                    ratio(F.col("revenue") - F.col("previous_revenue"), "previous_revenue").alias("growth"), (F.col("conversion") - F.col("previous_conversion")).alias("conversion_change"))


def feature_overview(store: DataFrame) -> DataFrame:
    """Per computed day: size, means, eligibility and median score."""
    d = store.groupBy("computed_date").agg(
        F.count(F.lit(1)).alias("features"), F.avg("performance.rps_smoothed").alias("avg_rps"), F.avg("performance.confidence").alias("avg_confidence"),
        F.avg(F.col("cooldown.eligible").cast("double")).alias("eligibility"), F.percentile_approx("scores.base_score", F.lit(0.5), F.lit(1000000)).alias("median_score"),
        F.countDistinct("account_page").alias("accounts"))
    w = Window.orderBy("computed_date")  # one row per day
    return d.withColumn("rps_change", F.col("avg_rps") - F.lag("avg_rps").over(w))


def top_templates(store: DataFrame, k: int = 100) -> DataFrame:
    s = store.select("account_page", "template", "category", F.round("performance.rps_smoothed", 9).alias("rps"), F.round("performance.confidence", 9).alias("confidence"),
                     F.round("scores.base_score", 9).alias("score"), "cooldown.eligible", "cooldown.fatigue")
    r = with_ranks(s, [("rps", [], "rps"), ("confidence", [], "confidence"), ("overall", [], "score")], descending=True)
    status = F.when(F.col("eligible"), "Eligible").when(F.col("fatigue") > 0.8, "Fatigued").otherwise("Cooling Down")
    return r.withColumn("status", status).orderBy("overall_rank", "account_page", "template").limit(k)  # a top-k report


def exploration_balance(store: DataFrame, new_below: int = 10, exploring_to: int = 50) -> DataFrame:
    n = F.col("performance.sends_30d")
    b = store.groupBy("account_page").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(n < new_below).alias("new"), F.count_if(n.between(new_below, exploring_to)).alias("exploring"), F.count_if(n > exploring_to).alias("exploiting"), F.avg("exploration.ucb").alias("avg_ucb"))
    return b.withColumn("status", F.when(F.col("new") > 0.3 * F.col("total"), "High Exploration").when(F.col("new") > 0.1 * F.col("total"), "Balanced").otherwise("Low Exploration"))


def best_hour_patterns(store: DataFrame) -> DataFrame:
    h = store.groupBy(F.col("timing.best_hour").alias("hour")).agg(F.count(F.lit(1)).alias("templates"), F.avg("timing.best_hour_rps").alias("best_rps"), F.avg("performance.rps_smoothed").alias("avg_rps"))
    return h.withColumn("lift_pct", 100 * ratio(F.col("best_rps") - F.col("avg_rps"), "avg_rps"))


def dataset_quality(store: DataFrame, fact: DataFrame) -> DataFrame:
    a = store.agg(F.lit("feature_store").alias("dataset"), F.count(F.lit(1)).alias("records"), F.count_if(F.col("template").isNull()).alias("missing_keys"),
                  F.count_if(F.col("performance.confidence") > 1).alias("out_of_range"), F.count_if((F.col("performance.sends_30d") == 0) & (F.col("performance.rps_30d") > 0)).alias("inconsistent"))
    b = fact.agg(F.lit("send_fact").alias("dataset"), F.count(F.lit(1)).alias("records"), F.count_if(F.col("template_key") == "UNKNOWN").alias("missing_keys"),
                 F.count_if(F.col("purchased") > F.col("sent")).alias("out_of_range"), F.count_if(F.col("quality") != "valid").alias("inconsistent"))
    return a.unionByName(b).withColumn("score_pct", 100 * (1 - ratio(F.col("missing_keys") + F.col("out_of_range"), "records")))


def refresh_gate(store: DataFrame, fact: DataFrame, as_of: str) -> DataFrame:
    """Health score and the conditional alerts of a finished refresh."""
    s = store.agg(F.count(F.lit(1)).alias("features"), F.avg("performance.confidence").alias("confidence"), F.avg(F.col("cooldown.eligible").cast("double")).alias("eligible_rate"),
                  F.count_if("cooldown.eligible").alias("eligible"), F.max("timing.last_sent_at").alias("latest"))
    sends = overall(fact.where(F.col("sent_date") == F.date_sub(clock.day(as_of), 1)), n=F.count(F.lit(1)))["n"]
    s = s.withColumns({"age_hours": clock.whole_units("HOUR", "latest", clock.moment(as_of)), "day_sends": sends})
    return s.withColumns({
        "health": F.when(F.col("age_hours") < 26, 25).otherwise(0) + F.when(F.col("eligible_rate") > 0.3, 25).otherwise(15)
        + F.when(F.col("day_sends") > 100, 25).otherwise(15) + F.when(F.col("confidence") > 0.05, 25).otherwise(15),
        "gate": F.when((F.col("features") > 100) & (F.col("confidence") > 0.05) & (F.col("eligible") > 50), "PASSED").otherwise("FAILED"),
        "alerts": present((F.col("age_hours") > 26, "stale"), (F.col("confidence") < 0.05, "low_confidence"), (F.col("eligible_rate") < 0.1, "low_eligibility"), (F.col("day_sends") < 10, "low_volume")),
    })


def data_quality_check(fact: DataFrame, as_of: str) -> DataFrame:
    """Freshness, last day's volume against the days before it, and rates."""
    last = F.date_sub(clock.day(as_of), 1)
    per_day = fact.where(clock.day_within("sent_date", as_of, 30)).groupBy("sent_date").agg(F.count(F.lit(1)).alias("n"), F.max("sent_at").alias("latest"))
    v = per_day.agg(F.sum(F.when(F.col("sent_date") == last, F.col("n"))).alias("rows_last_day"), F.avg(F.when(F.col("sent_date") < last, F.col("n"))).alias("avg_daily"),
                    F.stddev(F.when(F.col("sent_date") < last, F.col("n"))).alias("sd_daily"), F.max("latest").alias("latest"))
    n = F.count(F.lit(1))
    q = overall(fact.where(F.col("sent_date") == last), unknown=ratio(F.count_if(F.col("template_key") == "UNKNOWN"), n), views=ratio(F.count_if(F.col("viewed") > F.col("sent")), n),
                buys=ratio(F.count_if(F.col("purchased") > F.col("viewed")), n), invalid=ratio(F.count_if(F.col("quality") != "valid"), n))
    z = ratio(F.abs(F.col("rows_last_day") - F.col("avg_daily")), "sd_daily")
    v = v.withColumns({"staleness_minutes": clock.whole_units("MINUTE", "latest", clock.moment(as_of)), "volume_z": z, **{f"{k}_rate": c for k, c in q.items()}})
    return v.withColumns({
        "volume_status": F.when(F.col("volume_z") > 3, "ANOMALY").when(F.col("volume_z") > 2, "WARNING").otherwise("NORMAL"),
        "overall": F.when(F.col("staleness_minutes") > 120, "CRITICAL").when(F.col("volume_z") > 3, "WARNING_VOLUME").when(F.col("invalid_rate") > 0.1, "WARNING_QUALITY").otherwise("HEALTHY"),
    })


def landing_quality(reports: DataFrame) -> DataFrame:
    """Per landing day: rows, parse failures, duplicates of the dedup key."""
    p = parsed_reports(reports).withColumns({"template": F.sha2(F.lower("clean_message"), 256), "sent_date": F.to_date("sent_at")})
    keys = p.groupBy("ingestion_date", "template", "sender", "sent_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("message_id").isNull()).alias("no_id"), F.count_if(F.col("sent_at").isNull()).alias("no_time"),
        F.count_if(F.col("sent_date") > F.col("ingestion_date")).alias("future"), F.sum("sent").alias("sent"), F.sum("revenue").alias("rev"))
    d = keys.groupBy("ingestion_date").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("unique_keys"), F.sum("no_id").alias("no_id"), F.sum("no_time").alias("no_time"), F.sum("future").alias("future"),
        F.sum("sent").alias("sent"), num(F.sum("rev")).alias("revenue"))
    return d.withColumns({"duplicates": F.col("rows") - F.col("unique_keys"), "score": F.round(100 * (1 - ratio(F.col("no_id") + F.col("no_time"), "rows")))})


def plan_diversity(export: DataFrame) -> DataFrame:
    """Distinct templates per slot, per account and planned day."""
    c = export.groupBy("account", "date_local", "template").agg(F.count(F.lit(1)).alias("n"))
    d = c.groupBy("account", "date_local").agg(F.count(F.lit(1)).alias("templates"), F.sum("n").alias("slots"), F.max("n").alias("max_repeats"))
    r = ratio("templates", "slots")
    return d.withColumn("ratio", r).withColumn("status", F.when((F.col("ratio") < 0.85) | (F.col("max_repeats") > 5), "FAIL").when(F.col("ratio") < 0.90, "WARN").otherwise("PASS"))


def cooldown_violations(export: DataFrame) -> DataFrame:
    """Planned repeats of a template on an account sooner than 168 hours."""
    real = export.where(~F.col("template").like("FALLBACK%"))
    w = Window.partitionBy("account", "template").orderBy("date_local", "hod", "slot_rank")  # one week of slots
    at = F.datediff("date_local", F.lit("2000-01-01").cast("date")) * 24 + F.col("hod")
    g = real.withColumn("at", at).withColumn("gap", F.col("at") - F.lag("at").over(w)).where(F.col("gap").isNotNull())
    # The sample is cut per account before it is collected.
    few = top_k(g.where(F.col("gap") < 168), ["account"], [F.col("gap"), F.col("template"), F.col("at")], 5)
    sample = few.groupBy("account").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.concat("template", F.lit(" ("), F.col("gap").cast("string"), F.lit("h)")).alias("s")))), lambda x: x.s), ", ").alias("sample"))
    v = g.groupBy("account").agg(F.count(F.lit(1)).alias("repeats"), F.count_if(F.col("gap") < 168).alias("violations")).join(sample, "account", "left")
    rate = ratio("violations", "repeats")
    return v.withColumn("rate", rate).withColumn("status", F.when(F.col("violations") == 0, "PASS").when(F.col("rate") > 0.01, "FAIL").otherwise("WARN"))


def score_distribution(export: DataFrame) -> DataFrame:
    s = F.col("score")
    d = export.groupBy("account").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("lowest"), F.max("score").alias("highest"), F.avg("score").alias("mean"), F.stddev("score").alias("sd"),
        quantile("score", 0.5).alias("median"), F.count_if(s == 0).alias("zeros"), F.count_if((s < 0) | (s > 100)).alias("outside"))
    return d.withColumn("status", F.when(F.col("outside") > 0, "FAIL").when(F.col("sd") < 5, "WARN_LOW_VARIATION").when(F.col("zeros") > F.col("n") * 0.1, "WARN_ZEROS").otherwise("PASS"))


def plan_completeness(export: DataFrame) -> DataFrame:
    d = export.groupBy("date_local").agg(F.countDistinct("account").alias("accounts"), F.count(F.lit(1)).alias("rows"), F.count("template").alias("filled"), F.count_if(F.col("template").like("FALLBACK%")).alias("fallbacks"))
    d = d.withColumns({"fill_rate": ratio("filled", "rows"), "fallback_rate": ratio("fallbacks", "rows")})
    return d.withColumn("status", F.when(F.col("fill_rate") < 0.999, "FAIL").when(F.col("fallback_rate") > 0.03, "WARN").otherwise("PASS"))


# Quality thresholds (minimum, maximum) per metric.
THRESHOLDS = {"diversity": (0.85, None), "cooldown_compliance": (0.99, None), "score_quality": (0.5, None), "completeness": (0.999, None)}


def plan_health(export: DataFrame) -> DataFrame:
    """The four checks as metrics against their thresholds."""

    def metric(name: str, df: DataFrame, value: Column) -> DataFrame:
        low, high = THRESHOLDS[name]
        m = df.agg(F.lit(name).alias("metric"), value.alias("value"), F.min(F.when(F.col("status").startswith("FAIL"), 0).otherwise(1)).alias("all_pass"))
        bad = F.lit(False) if low is None else F.col("value") < low
        over = F.lit(False) if high is None else F.col("value") > high
        return m.withColumn("status", F.when(bad, "FAIL_LOW").when(over, "FAIL_HIGH").when(F.col("all_pass") == 0, "FAIL_SOME").otherwise("PASS"))

    return (
        metric("diversity", plan_diversity(export), F.avg("ratio")).unionByName(metric("cooldown_compliance", cooldown_violations(export), 1 - F.avg("rate")))
        .unionByName(metric("score_quality", score_distribution(export), F.avg((F.col("status") == "PASS").cast("double"))))
        .unionByName(metric("completeness", plan_completeness(export), F.avg("fill_rate")))
    )


def reconciliation(facts: DataFrame, fact: DataFrame) -> DataFrame:
    """Old and new copies of the sends side by side, with row-count checks."""
    def side(df: DataFrame, name: str, account: str, template: str) -> DataFrame:
        return df.agg(F.lit(name).alias("system"), F.countDistinct(template).alias("templates"), F.countDistinct(account).alias("accounts"), F.count(F.lit(1)).alias("sends"), num(F.sum("earnings")).alias("revenue"))

    valid = fact.where(F.col("quality") == "valid")
    return side(facts, "source", "account", "template").unionByName(side(fact, "fact", "account_key", "template_key")).unionByName(side(valid, "valid", "account_key", "template_key"))


def table_health(name: str, df: DataFrame, keys: list[str], day: Column | None, as_of: str, stale_days: int = 2) -> DataFrame:
    """Rows, missing and repeated keys and the latest day of one table, with its status, in one row."""
    missing = F.greatest(*[F.col(k).isNull().cast("int") for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull().cast("int")
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(day if day is not None else F.lit(None).cast("date")).alias("latest"))
    a = per_key.withColumn("missing", missing).agg(
        F.lit(name).alias("dataset"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.coalesce(F.sum(F.col("n") * F.col("missing")), F.lit(0)).alias("missing_keys"),
        F.coalesce(F.sum((F.col("n") - 1) * (1 - F.col("missing"))), F.lit(0)).alias("repeated_keys"), F.max("latest").alias("latest"))
    old = F.coalesce(clock.days_between(clock.day(as_of), "latest") > stale_days, F.lit(False))
    return a.withColumn("status", F.when(F.col("records") == 0, "EMPTY").when(F.col("missing_keys") + F.col("repeated_keys") > 0, "KEY ISSUES").when(old, "STALE").otherwise("HEALTHY"))


def with_overall(tables: list[DataFrame]) -> DataFrame:
    """The tables' health and one row for all of them: healthy if none is empty and no key is missing."""
    each = tables[0]
    for t in tables[1:]:
        each = each.unionByName(t)
    bad = F.count_if((F.col("status") == "EMPTY") | (F.col("missing_keys") > 0))
    whole = each.agg(
        F.lit("all").alias("dataset"), F.sum("records").alias("records"), F.sum("missing_keys").alias("missing_keys"), F.sum("repeated_keys").alias("repeated_keys"),
        F.max("latest").alias("latest"), F.when(bad == 0, "HEALTHY").otherwise("ISSUES DETECTED").alias("status"))
    return each.unionByName(whole)


def bank_quality(templates: DataFrame) -> DataFrame:
    t = F.col("_tokens")
    f = templates.withColumn("_tokens", text.tokens("body")).select(
        "category", F.length("body").alias("n"), text.emoji_count("body").alias("emojis"), text.has_cta("body", t).alias("cta"), text.has_urgency("body", t).alias("urgent"),
        text.ends_with_question("body").alias("question"), text.length_bin("body").alias("length_bin"), text.content_level("body", pieces=t).alias("level"))
    return f.groupBy("category").agg(
        F.count(F.lit(1)).alias("templates"), F.avg("n").alias("avg_length"), F.avg("emojis").alias("avg_emojis"), F.count_if("cta").alias("with_cta"), F.count_if("urgent").alias("with_urgency"),
        F.count_if("question").alias("questions"), F.count_if(F.col("n") > 500).alias("very_long"),
        F.array_join(F.array_sort(F.collect_set("length_bin")), ",").alias("length_bins"), F.array_join(F.array_sort(F.collect_set("level")), ",").alias("levels"))


def onboarding_gaps(reports: DataFrame, known: DataFrame, as_of: str, quiet_minutes: int = 120) -> DataFrame:
    """Accounts that report lately but are not in the dimension."""
    r = parsed_reports(reports).where(clock.within_days("sent_at", as_of, 2)).groupBy(F.col("file_account").alias("name")).agg(F.max("sent_at").alias("last_seen"))
    return r.join(known.select("name"), "name", "left_anti").where(clock.whole_units("MINUTE", "last_seen", clock.moment(as_of)) > quiet_minutes)


def freshness(facts: DataFrame, as_of: str) -> DataFrame:
    m = facts.agg(F.max("sent_at").alias("latest"))
    return m.withColumn("minutes", clock.whole_units("MINUTE", "latest", clock.moment(as_of))).withColumn("needs_refresh", F.col("minutes") > 24 * 60)


def backtest(ranked: DataFrame, facts: DataFrame) -> DataFrame:
    """Mean revenue per send of recommended templates against all of them."""
    act = facts.where("sent > 0").groupBy("account", "template").agg(ratio(dsum("earnings"), F.sum("sent")).alias("rps"))
    picked = ranked.select("account", "template").distinct().withColumn("picked", F.lit(1))
    j = act.join(picked, ["account", "template"], "left")
    s = j.agg(F.avg("rps").alias("old_rps"), F.avg(F.when(F.col("picked") == 1, F.col("rps"))).alias("new_rps"), F.count("picked").alias("pairs"))
    return s.withColumn("improvement_pct", 100 * ratio(F.col("new_rps") - F.col("old_rps"), "old_rps"))


def template_banks(perf: DataFrame, categories: DataFrame, k: int = 100) -> DataFrame:
    """Top templates per category by smoothed revenue."""
    p = perf.groupBy("template").agg(F.avg("rps").alias("rps"), F.sum("total_sent").alias("sent"))
    j = salted_lookup(p, categories.select("template", "category"), ["template"], "inner").withColumn("rps", F.round("rps", 9))
    return top_k(j, ["category"], [F.col("rps").desc(), F.col("template")], k)


def week_plan_scored(plan: DataFrame, scorecard: DataFrame, alerts: DataFrame) -> DataFrame:
    """Plan rows with the slot's score and any feasibility notice of the day."""
    j = salted_lookup(plan.select("account", "account_page", "date_local", "dow", "hod", "slot_rank", "price"), scorecard.select("account_page", "dow", "hod", "slot_score"), ["account_page", "dow", "hod"])
    n = alerts.select("account", "date_local", F.lit("window too narrow").alias("notice"))
    return salted_lookup(j, n, ["account", "date_local"])
