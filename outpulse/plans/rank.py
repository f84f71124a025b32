"""Ranking message copy for upcoming slots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.functions import clock
from outpulse.functions.hashing import beta_mean_jitter, hash_int, hash_uniform
from outpulse.functions.numeric import dsum, ladder, num, ratio, ucb_bonus, whole
from outpulse.operators.joins import group_stats, overall, salted_lookup
from outpulse.operators.ranking import top_k
from outpulse.plans.semantic import STYLE
from outpulse.session import stabilise


def rank_templates(ready: DataFrame, as_of: str, k: int, mode: str = "ucb") -> DataFrame:
    """Top templates of every account under one bandit policy."""
    seed = [F.col("account_page"), F.lit(as_of[:13]), F.col("template")]
    mean, trials = F.col("performance.rps_smoothed"), F.col("performance.sends_30d")
    bought = F.col("performance.buy_30d") * trials
    rows = group_stats(ready.where("cooldown.eligible"), ["account_page"], total_trials=F.sum(trials))
    bonus = ucb_bonus("total_trials", trials, F.coalesce("ucb_c", F.lit(1.0)))
    explore = hash_uniform(*seed) < F.coalesce("epsilon", F.lit(0.1))
    score = {
        "ucb": mean + bonus,
        "epsilon_greedy": F.when(explore, hash_uniform(*seed, F.lit("explore"))).otherwise(mean),
        "thompson": beta_mean_jitter(
            F.coalesce("alpha", F.lit(1.0)) + bought, F.coalesce("beta", F.lit(1.0)) + trials - bought, *seed
        ),
        "mean": mean,
    }[mode]
    scored = rows.select("account_page", "template", score.alias("score"), mean.alias("baseline"), bonus.alias("bonus"), F.lit(mode).alias("mode"))
    return top_k(scored, ["account_page"], [F.col("score").desc(), F.col("template")], k)


@dataclass(frozen=True)
class RankerParams:
    performance: float = 0.4
    exploration: float = 0.2
    recency: float = 0.2
    stability: float = 0.2
    epsilon_percent: int = 10
    prefer: str = "rested"  # or "recent"
    hours: int = 24
    keep: int = 10


def slot_ranking(store: DataFrame, as_of: str, params: RankerParams = RankerParams()) -> DataFrame:
    """Eligible templates for every hourly slot of the next day.

    The slot grid is a narrow explode on the template rows, after they are dealt
    by account page: no account x hour row is shuffled, unless a page is so hot
    that adaptive execution splits its rows.  Equal scores of a slot are counted
    in a window, which holds no more than the page's templates.
    """
    p = params
    ok = store.where("cooldown.eligible")
    fresh = F.exp(-0.1 * F.col("timing.hours_since_use") / 24)
    recency = fresh if p.prefer == "recent" else 1 - fresh
    parts = ok.select(
        "account_page", "template", F.col("scores.rps_pct").alias("performance_part"),
        F.col("exploration.ucb").alias("exploration_part"), recency.alias("recency_part"),
        F.col("performance.stability").alias("stability_part"), F.col("timing.best_hour").alias("best_hour"),
        F.col("performance.rps_smoothed").alias("expected_rps"), F.col("performance.confidence").alias("confidence"),
        (F.col("timing.hours_since_use") / 24).alias("days_since_use"), F.col("performance.sends_30d").alias("recent_sends"),
    )
    slots = F.sequence(clock.moment(as_of), clock.moment(as_of) + F.make_dt_interval(hours=F.lit(p.hours)), F.expr("interval 1 hour"))
    n = ok.groupBy("account_page").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.join(n.hint("merge"), "account_page")
    grid = parts.withColumn("slot_at", F.explode(slots)).withColumn("slot_hour", F.hour("slot_at"))
    key = [F.col("template"), F.date_format("slot_at", "yyyyMMddHH")]
    base = (
        p.performance * F.col("performance_part") + p.exploration * F.col("exploration_part")
        + p.recency * F.col("recency_part") + p.stability * F.col("stability_part")
    )
    gap = F.abs(F.col("slot_hour") - F.col("best_hour"))
    boost = F.when(gap == 0, 1.2).when(gap <= 2, 1.1).otherwise(1.0)
    scored = grid.withColumn(
        "score",
        F.when(hash_int(*key) % 100 < p.epsilon_percent, hash_uniform(*key, F.lit("explore"))).otherwise(base) * boost,
    )
    slot = ["account_page", "slot_at"]
    # Percent rank of the kept rows: rows below = all - better - tied.
    scored = scored.where(F.col("score").isNotNull()).withColumn("tied", F.count(F.lit(1)).over(Window.partitionBy(*slot, "score")))
    best = top_k(scored, slot, [F.col("score").desc(), F.col("template")], p.keep)
    w = Window.partitionBy(*slot).orderBy(F.col("score").desc())  # at most ``keep`` rows
    ranked = best.withColumn("better", F.rank().over(w) - 1)
    return ranked.select(
        "*",
        F.when(F.col("n") > 1, (F.col("n") - F.col("better") - F.col("tied")) / (F.col("n") - 1)).otherwise(F.lit(0.0)).alias("score_pct"),
        F.when(F.col("rank") == 1, "primary").when(F.col("rank") <= 3, "secondary").when(F.col("rank") <= 5, "backup")
        .otherwise("alternative").alias("recommendation"),
        (F.col("exploration_part") > F.col("performance_part")).alias("is_exploration"),
    ).drop("better", "tied", "n")


def schedule_recommendations(ranked: DataFrame, templates: DataFrame, k: int = 5) -> DataFrame:
    """Best ``k`` per slot with a short preview of the copy."""
    t = templates.select("template", F.substring("body", 1, 200).alias("preview"), "category")
    return salted_lookup(ranked.where(F.col("rank") <= k), t, ["template"], "inner").select(
        "account_page", F.to_date("slot_at").alias("schedule_date"), F.col("slot_hour").alias("schedule_hour"), "template",
        "preview", "category", "rank", "score", "expected_rps", "confidence", "days_since_use", "recommendation", "is_exploration",
    )


def template_lookup(store: DataFrame, templates: DataFrame, as_of: str) -> DataFrame:
    """One row per template: tier, availability and last use over accounts."""
    m = store.groupBy("template").agg(
        F.max("timing.last_sent_at").alias("last_used_at"), F.avg("performance.rps_smoothed").alias("avg_rps"),
        F.avg("performance.confidence").alias("avg_confidence"), F.min("cooldown.eligible").alias("available"),
    )
    r = F.col("avg_rps")
    return templates.select("template", "category", F.length("body").alias("body_length")).join(m, "template", "left").select(
        "template", "category", "body_length",
        F.when(r >= 1.0, "top").when(r >= 0.5, "good").when(r >= 0.2, "average").when(r.isNull(), "new").otherwise("explore").alias("tier"),
        F.coalesce("available", F.lit(True)).alias("available"), "last_used_at",
        clock.whole_units("DAY", "last_used_at", clock.moment(as_of)).alias("days_since_use"),
        F.coalesce("avg_rps", F.lit(0.0)).alias("expected_rps"), F.coalesce("avg_confidence", F.lit(0.0)).alias("confidence"),
    )


def select_templates(recommended: DataFrame, strategy: str, k: int = 3) -> DataFrame:
    """Pick per slot: exploit the best, explore first, or keep the balance."""
    explore_first = F.when(F.col("is_exploration"), 0).otherwise(1)
    order = {
        "exploit": [F.col("score").desc()],
        "explore": [explore_first, F.col("score").desc()],
        "balanced": [F.when(hash_uniform("account_page", "schedule_hour", "template") < 0.1, 0).otherwise(1), F.col("score").desc()],
    }[strategy]
    return top_k(recommended, ["account_page", "schedule_date", "schedule_hour"], [*order, F.col("template")], k, "pick")


@dataclass(frozen=True)
class DiversityParams:
    nu_buy: float = 200.0
    w_style: float = 0.10
    sigma_min: float = 0.15
    sigma_max: float = 0.60
    cap: float = 2.0
    block_hours: int = 6
    same_day_penalty: float = 1.0
    cross_account_penalty: float = 0.75
    ban: bool = False
    default_buy: float = 0.08


def with_fallbacks(pool: DataFrame, slots: DataFrame) -> DataFrame:
    """Candidates of the accounts in play, plus one stand-in per account that
    has none."""
    pages = slots.select("account_page").distinct()
    mine = pool.join(pages, "account_page", "left_semi")
    cols = ["account_page", "template", *STYLE, "last_used_at", "cooldown_ok"]
    empty = pages.join(pool.select("account_page").distinct(), "account_page", "left_anti").select(
        "account_page", F.concat_ws("|", "account_page", F.lit("fallback")).alias("template"),
        F.lit("short").alias("length_bin"), F.lit("none").alias("emoji_bin"), F.lit(False).alias("has_cta"),
        F.lit(False).alias("has_urgency"), F.lit(False).alias("ends_with_question"),
        F.lit(None).cast("timestamp_ntz").alias("last_used_at"), F.lit(True).alias("cooldown_ok"),
    )
    return mine.select(*cols).unionByName(empty)


def preliminary_scores(
    slots: DataFrame, pool: DataFrame, style: DataFrame, stats: DataFrame, priors: DataFrame, dm: DataFrame,
    as_of: str, params: DiversityParams = DiversityParams(),
) -> DataFrame:
    """Slot x candidate scores: shrunk buy rate x price, adaptive exploration
    bonus and style lift.  An account has at most 24 slots, so its slots travel
    as one array to the candidates and explode there; a hot account's
    candidates stay spread over tasks."""
    p = params
    cand = with_fallbacks(pool, slots)
    ok = cand.groupBy("account_page").agg(F.sum(F.col("cooldown_ok").cast("int")).alias("ok_count"))
    # What belongs to the slot meets it before the candidates do: its volume and the styles lifted in its hour.
    hour = ["account_page", "dow", "hod"]
    slot_volume = dm.groupBy(*hour).agg(F.sum("sent").alias("sent_28d"))
    lifts = style.groupBy(*hour).agg(F.collect_list(F.struct(*STYLE, "lift_clamped")).alias("lifts"))
    slots = salted_lookup(salted_lookup(slots, slot_volume, hour), lifts, hour)
    packed = slots.groupBy("account_page").agg(F.collect_list(
        F.struct("slot_at", "dow", "hod", F.greatest(F.col("price"), F.lit(0.0)).alias("price"), "sent_28d", "lifts")).alias("slots"))
    volume = stats.groupBy("account_page").agg(F.sum("decayed_sent").alias("account_volume"))
    side = packed.join(ok, "account_page", "left").join(volume, "account_page", "left").join(priors, "account_page", "left")
    rows = cand.join(stats, ["account_page", "template"], "left").join(side.hint("merge"), "account_page")
    rows = rows.withColumn("s", F.explode("slots")).select("*", "s.*").drop("s", "slots")

    def same_style(x: Column) -> Column:
        out = F.lit(True)
        for c in STYLE:
            out = out & (x[c] == F.col(c))
        return out

    rows = rows.withColumn("lift_clamped", F.get(F.filter("lifts", same_style), F.lit(0)).lift_clamped).drop("lifts")
    n = F.coalesce("decayed_sent", F.lit(0.0))
    mu = F.coalesce("mu_buy", F.lit(p.default_buy))
    buy = (F.coalesce("decayed_bought", F.lit(0.0)) + p.nu_buy * mu) / (n + p.nu_buy)

    def damp(x) -> Column:
        return 1 / (1 + F.log10(1 + F.coalesce(num(x), F.lit(0.0))))

    rows = rows.withColumns({
        "p_buy": buy, "style_score": p.w_style * F.coalesce("lift_clamped", F.lit(0.0)),
        "sigma": p.sigma_min + (p.sigma_max - p.sigma_min) * (0.5 * damp("sent_28d") + 0.5 * damp("account_volume")),
        "idle_days": F.coalesce(clock.whole_units("DAY", "last_used_at", clock.moment(as_of)), F.lit(999999)),
    }).withColumn("rps_eb", F.round(F.col("price") * F.col("p_buy"), 9))
    raw = F.when(
        F.col("price") > 0,
        F.col("sigma") * F.col("price") * F.sqrt(F.greatest(F.col("p_buy") * (1 - F.col("p_buy")), F.lit(0.0)) / F.greatest(n + p.nu_buy, F.lit(1.0))),
    ).otherwise(F.lit(0.0))
    rows = rows.withColumn("bonus", F.least(raw, p.cap * F.col("price") * F.col("p_buy")))
    relaxed = F.when(F.col("cooldown_ok") | (F.col("ok_count") > 0), F.lit(0.0)).otherwise(-0.000001 * F.col("idle_days"))
    return rows.select(
        "account_page", "slot_at", "dow", "hod", "template", "price", "p_buy", "rps_eb", "bonus", "style_score", "cooldown_ok",
        # Nine places: sums taken in another order must still tie.
        F.round(F.col("rps_eb") + F.col("bonus") + F.col("style_score") + relaxed, 9).alias("preliminary"),
    )


def diverse_ranking(
    preliminary: DataFrame, params: DiversityParams = DiversityParams(), keep: int | None = None, stable: bool = False
) -> DataFrame:
    """Penalise (or ban) repeats of a template within an account's day and
    near slots that another account gives to the same template.

    The cross-account test never pairs rows: slot winners are reduced to the
    smallest and largest account per template and hour, and a row conflicts
    when any hour within the block holds an account other than its own.  The
    hours a template has won, some fifty, travel as one array of the template;
    rows are dealt once, by template, and ranked within the day where they are.
    """
    p = params
    pre = preliminary if stable else stabilise(preliminary)
    day = Window.partitionBy("account_page", F.to_date("slot_at"), "template").orderBy(
        F.col("preliminary").desc(), "slot_at"
    )  # at most 24 rows: one account, template and day
    winners = top_k(pre, ["account_page", "slot_at"], [F.col("preliminary").desc(), F.col("template")], 1).select(
        "account_page", "template", F.expr("timestampdiff(HOUR, timestamp_ntz'1970-01-01 00:00:00', slot_at)").alias("h")
    )
    per_hour = winners.groupBy("template", "h").agg(F.min("account_page").alias("lo"), F.max("account_page").alias("hi"))
    won = per_hour.groupBy("template").agg(
        F.min("lo").alias("_lo"), F.max("hi").alias("_hi"), F.collect_list(F.struct("h", "lo", "hi")).alias("_won"))
    rows = salted_lookup(pre, won, ["template"])

    def of_another(lo: Column, hi: Column) -> Column:
        return (lo != F.col("account_page")) | (hi != F.col("account_page"))

    hour_no = F.expr("timestampdiff(HOUR, timestamp_ntz'1970-01-01 00:00:00', slot_at)")
    near = F.exists("_won", lambda x: (F.abs(x.h - hour_no) <= p.block_hours) & of_another(x.lo, x.hi))
    # Most copy is won by one account alone: its rows need not look at the hours.
    clash = F.coalesce(of_another(F.col("_lo"), F.col("_hi")) & near, F.lit(False))
    rows = rows.select(*pre.columns, clash.alias("conflict")).withColumn("same_day_rank", F.row_number().over(day))
    rows = rows.select(*pre.columns, "same_day_rank", "conflict")
    if p.ban:
        rows = rows.where((F.col("same_day_rank") == 1) & ~F.col("conflict")).withColumn("score", F.col("preliminary"))
    else:
        unit = F.greatest(F.col("rps_eb"), F.lit(0.0005))
        rows = rows.withColumn(
            "score",
            F.col("preliminary") - F.when(F.col("same_day_rank") > 1, p.same_day_penalty * unit).otherwise(F.lit(0.0))
            - F.when(F.col("conflict"), p.cross_account_penalty * unit).otherwise(F.lit(0.0)),
        )
    slot, order = ["account_page", "slot_at"], [F.col("score").desc(), F.col("template")]
    if keep is not None:
        return top_k(rows, slot, order, keep)
    return rows


# Default ranking weights per state, and the state each planning mode uses.
STATE_WEIGHTS = {
    "harvest": dict(rps=0.35, open=0.20, buy=0.15, timing=0.10, price=0.10, novelty=0.05, momentum=0.05, ucb_c=1.2, epsilon=0.05),
    "build": dict(rps=0.28, open=0.18, buy=0.14, timing=0.12, price=0.12, novelty=0.08, momentum=0.08, ucb_c=1.5, epsilon=0.10),
    "recover": dict(rps=0.22, open=0.18, buy=0.18, timing=0.12, price=0.12, novelty=0.09, momentum=0.09, ucb_c=1.7, epsilon=0.15),
    "balance": dict(rps=0.30, open=0.20, buy=0.15, timing=0.10, price=0.10, novelty=0.075, momentum=0.075, ucb_c=1.4, epsilon=0.08),
}
MODE_STATE = {"grow": "build", "retain": "harvest", "balance": "balance"}


def latest_settings(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key of a settings table, so joins never multiply rows."""
    return top_k(rows, keys, [F.col("updated_at").desc()], 1, "_r").drop("_r")


def weighted_ranking(
    plan: DataFrame, perf: DataFrame, facts: DataFrame, accounts: DataFrame, timing: DataFrame, categories: DataFrame,
    as_of: str, keep: int = 20, min_cooldown_hours: int = 6, max_weekly_uses: int = 3, settings: DataFrame | None = None,
) -> DataFrame:
    """Planned slots x the account's templates, scored with the weights of the
    account's state, with reason codes and eligibility-first order.

    ``settings`` holds weights per ``page_state`` under the names of
    ``STATE_WEIGHTS``, the newest row of a state (``updated_at``) being used; a
    state without a row, or a weight that is NULL there, takes the default.
    """
    week = clock.within_days("sent_at", as_of, 7)
    use = facts.groupBy("account", "template").agg(
        F.max("sent_at").alias("last_sent"), F.count_if(week).alias("uses_7d"), F.countDistinct(F.when(week, F.col("sent_date"))).alias("days_7d"),
    )
    month = facts.where(clock.within_days("sent_at", as_of, 30) & (F.col("sent") > 0))
    momentum = month.groupBy("account").agg(
        ratio(ratio(F.sum(F.when(week, F.col("earnings"))), F.sum(F.when(week, F.col("sent")))), ratio(dsum("earnings"), F.sum("sent"))).alias("momentum")
    )
    band = F.when(F.col("price") < 15, "low").when(F.col("price") < 30, "mid").when(F.col("price") < 45, "high").otherwise("premium")
    bands = (
        facts.where(clock.within_days("sent_at", as_of, 90) & (F.col("sent") > 0)).groupBy("account", band.alias("band"))
        .agg(F.avg(ratio("earnings", "sent")).alias("r")).groupBy("account")
        .agg(F.max_by("band", F.struct("r", "band")).alias("best_band"), F.max("r").alias("best_band_rps"))
    )
    percent = F.percent_rank().over(Window.partitionBy("account").orderBy("score"))  # at most 168 rows per account
    hours = timing.withColumn("timing_pct", percent)
    weight = {
        name: F.element_at(F.create_map(*[x for mode, state in MODE_STATE.items() for x in (F.lit(mode), F.lit(STATE_WEIGHTS[state][name]))]), F.col("page_state"))
        for name in next(iter(STATE_WEIGHTS.values()))
    }
    if settings is not None:
        weight = {name: F.coalesce(F.col(f"_w_{name}"), default) for name, default in weight.items()}
    # Only accounts with copy to rank; slots without a day or an hour are none.
    mine = plan.where(F.col("date_local").isNotNull() & F.col("hod").isNotNull()).join(perf.select("account").distinct(), "account", "left_semi")
    named = F.concat_ws(":", F.date_format("date_local", "yyyyMMdd"), "hod").alias("named")  # as exploration hashes it
    packed = mine.join(hours.select("account", "dow", "hod", "timing_pct", F.col("score").alias("timing_score")), ["account", "dow", "hod"], "left").groupBy("account").agg(
        F.collect_list(F.struct("date_local", "hod", "dow", "slot_rank", "timing_pct", "timing_score", named)).alias("slots")  # a week's slots
    )
    side = (
        packed.join(accounts.select("account", "page_type", "page_state"), "account").join(momentum, "account", "left").join(bands, "account", "left")
    )
    if settings is not None:
        have = [name for name in weight if name in settings.columns]
        live = latest_settings(settings, ["page_state"]).select(
            "page_state", *[(F.col(n).cast("double") if n in have else F.lit(None).cast("double")).alias(f"_w_{n}") for n in weight])
        side = salted_lookup(side, live, ["page_state"])
    # Both runs over the slots must see the same means.
    side = stabilise(side.withColumns({f"_w_{name}": w for name, w in weight.items()}))
    pairs = salted_lookup(perf.join(use, ["account", "template"], "left"), categories.select("template", "category"), ["template"], "inner")
    w = {name: F.col(f"_w_{name}") for name in weight}

    def at_slots(side: DataFrame) -> DataFrame:
        """Each pair at each slot of its account.  The pairs are shuffled by account, the slots come out of an array
        there: what ranks or counts per account and slot finds its rows in one place, and no slot row is shuffled.
        What belongs to the pair is worked out before its slots come out."""
        rows = of_pair(pairs.join(side.hint("merge"), "account"))
        return scored(rows.withColumn("s", F.explode("slots")).select("*", "s.*").drop("s", "slots"))

    def of_pair(rows: DataFrame) -> DataFrame:
        price_fit = F.when((F.col("best_band") == "mid") & (F.col("rps") > F.col("best_band_rps")), 0.2).when(
            (F.col("best_band") == "high") & (F.col("rps") > F.col("best_band_rps")), 0.1).otherwise(0.0)
        idle = clock.whole_units("HOUR", "last_sent", clock.moment(as_of))
        return rows.withColumns({
            "_copy": w["rps"] * F.col("rps_z") + w["open"] * F.col("open_rate_z") + w["buy"] * F.col("conversion_z"),
            "_price": w["price"] * price_fit, "_novelty": w["novelty"] * F.col("novelty"),
            "_momentum": w["momentum"] * F.least(F.lit(1.5), F.greatest(F.lit(0.5), F.coalesce("momentum", F.lit(1.0)))),
            "_cold": w["ucb_c"] * F.col("exploration"),
            "cooldown_ok": ~F.coalesce((F.col("uses_7d") >= max_weekly_uses) | (F.col("days_7d") >= 3) | (idle < min_cooldown_hours), F.lit(False)),
            "dedupe_ok": ~F.coalesce(F.col("uses_7d") > 0, F.lit(False)),
        })

    def scored(rows: DataFrame) -> DataFrame:
        pct = F.coalesce("timing_pct", F.lit(0.5))
        rows = rows.withColumn("explore", hash_uniform("template", "named") < w["epsilon"])
        # Added up in the order of the weights: equal sums must tie.
        score = (
            F.col("_copy") + w["timing"] * (pct - 0.5) * 2 + F.col("_price") + F.col("_novelty") + F.col("_momentum")
            + F.when(F.col("cold_start"), F.col("_cold")).when(F.col("explore"), F.lit(2.0)).otherwise(F.lit(0.0))
        )
        return rows.withColumns({
            "score": score,
            "reason": F.when(F.col("cold_start"), "cold_start_exploration").when(F.col("explore"), "epsilon_exploration")
            .when(F.col("rps_pct") > 0.8, "high_performer").when(F.col("timing_pct") > 0.7, "optimal_timing")
            .when(F.col("novelty") > 0.9, "fresh_content").otherwise("balanced_selection"),
        }).drop(*[f"_w_{name}" for name in weight], "_copy", "_price", "_novelty", "_momentum", "_cold", "named")

    # Slot ranges come from a partial aggregate, not from a window over the slot; they go back into the account's
    # array of slots.  Every slot of an account has all its copy, so the categories are those of the account.
    spans = at_slots(side).groupBy("account", "date_local", "hod").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    of_account = spans.groupBy("account").agg(F.collect_list(F.struct("date_local", "hod", "lo", "hi")).alias("spans"))
    kinds = pairs.join(side.select("account").hint("merge"), "account").groupBy("account").agg(F.countDistinct("category").alias("categories"))

    def with_span(s: Column) -> Column:
        span = F.get(F.filter("spans", lambda x: (x.date_local == s.date_local) & (x.hod == s.hod)), F.lit(0))
        return F.struct(*[s[c].alias(c) for c in ("date_local", "hod", "dow", "slot_rank", "timing_pct", "timing_score", "named")],
                        *[span[c].alias(c) for c in ("lo", "hi")])

    rows = at_slots(side.join(of_account, "account").join(kinds, "account").withColumn("slots", F.transform("slots", with_span)).drop("spans"))
    order = [F.when(F.col("cooldown_ok") & F.col("dedupe_ok"), 0).otherwise(1), F.col("score").desc(), F.col("days_since_used").desc(), F.col("template")]
    # A number of the slot comes first, which spares the sort most comparisons of strings.
    slot = ["account", "date_local", "hod"]
    best = top_k(rows.withColumn("_slot", F.xxhash64(*slot)), ["_slot", *slot], order, keep).drop("_slot")
    return best.withColumn("score_100", 100 * ratio(F.col("score") - F.col("lo"), F.col("hi") - F.col("lo"))).drop("lo", "hi")


@dataclass(frozen=True)
class CooldownLimits:
    min_days: int = 1
    max_days: int = 21


def smart_cooldowns(
    ranked: DataFrame, levels: DataFrame, fatigue: DataFrame, used: DataFrame, engagement: DataFrame, volume: DataFrame,
    accounts: DataFrame, as_of: str,
) -> DataFrame:
    """Days a template rests on an account: base x fatigue x sharing x volume."""
    page = accounts.select("account", "account_page")
    keyed = salted_lookup(ranked, page, ["account_page"], "inner")
    q = overall(
        keyed, **{n: F.percentile_approx(c, F.lit(x), F.lit(1000000)) for n, c, x in (("rps75", "rps_eb", 0.75), ("rps90", "rps_eb", 0.9), ("score75", "score", 0.75))}
    )
    shared = keyed.groupBy("template").agg(F.countDistinct("account_page").alias("accounts_using"))
    template_side = shared.join(levels.select("template", "content_level"), "template", "left").join(
        engagement.select("template", "engagement"), "template", "left")
    # Rolling mean over the template's slots: hours are summed first, so the
    # frame runs over at most one row per template and hour.
    hourly = keyed.groupBy("template", "slot_at").agg(F.avg("score").alias("hour_score"))
    hourly = hourly.withColumn("rolling", F.avg("hour_score").over(Window.partitionBy("template").orderBy("slot_at").rowsBetween(-7, 0)))
    best = keyed.groupBy("account", "account_page", "template").agg(
        F.max("rps_eb").alias("rps"), F.max("score").alias("score"), F.max("slot_at").alias("slot_at"))
    b = salted_lookup(best, hourly.select("template", "slot_at", "rolling"), ["template", "slot_at"])
    b = salted_lookup(b, template_side, ["template"])
    b = b.join(fatigue.select("account", "template", "fatigue"), ["account", "template"], "left").join(used, ["account", "template"], "left")
    b = salted_lookup(b, volume.select("account", "volume_tier"), ["account"])
    b = b.withColumns({"rps75": q["rps75"], "rps90": q["rps90"], "score75": q["score75"], "fatigue": F.coalesce("fatigue", F.lit(0.0)),
                       "volume_tier": F.coalesce("volume_tier", F.lit("MINIMAL_VOLUME")), "engagement": F.coalesce("engagement", F.lit(0.5))})
    level = F.col("content_level")
    base = F.when(F.col("rps") > F.col("rps90"), 2).when(F.col("rps") > F.col("rps75"), 3).when(level == "explicit", 10).when(level == "moderate", 7).otherwise(5)
    b = b.withColumn("base_days", base)
    factor = (
        ladder("fatigue", (0.8, 1.8), (0.5, 1.4), (0.3, 1.2), default=1.0) * ladder("accounts_using", (6, 1.5), (4, 1.3), (2, 1.1), default=1.0)
        * F.when(F.col("volume_tier") == "HIGH_VOLUME", 0.8).when(F.col("volume_tier") == "MEDIUM_VOLUME", 0.9)
        .when(F.col("volume_tier") == "LOW_VOLUME", 1.0).otherwise(1.2)
    )
    b = b.withColumn("rest_days", whole(F.col("base_days") * factor)).withColumn("cooldown_days", F.greatest(F.col("rest_days"), F.lit(1)))
    return b.select(
        "account", "account_page", "template", "fatigue", "last_used_at", "base_days", "accounts_using", "rolling", "volume_tier", "cooldown_days",
        F.coalesce(F.col("last_used_at") + F.make_dt_interval(days=F.col("rest_days").cast("int")), clock.moment(as_of)).alias("available_after"),
        ((F.col("rolling") > F.col("score75")) & (F.col("fatigue") < 0.3) & (F.col("engagement") > 0.6)).alias("override_suggested"),
        ((F.col("rolling") > F.col("score75")) & (F.col("rps") > F.col("rps75")) & (F.col("fatigue") < 0.5)).alias("emergency_override"),
        F.when(F.col("rps") > F.col("rps90"), "ELITE").when(F.col("rps") > F.col("rps75"), "HIGH_PERFORMER").when(F.col("rps") > 0, "AVERAGE")
        .otherwise("UNTESTED").alias("performance_tier"),
    )


def availability(cooldowns: DataFrame, as_of: str) -> DataFrame:
    """Whether each template may be sent now, as a join input instead of a
    per-row lookup."""
    return cooldowns.select("account", "template", "available_after", (F.col("available_after") <= clock.moment(as_of)).alias("is_available"))


def cooldown_report(cooldowns: DataFrame) -> DataFrame:
    return cooldowns.groupBy("performance_tier").agg(
        F.count(F.lit(1)).alias("templates"), F.avg("cooldown_days").alias("avg_days"), F.min("cooldown_days").alias("min_days"),
        F.max("cooldown_days").alias("max_days"), F.count_if("override_suggested").alias("overrides"),
        F.count_if("emergency_override").alias("emergencies"),
    )
