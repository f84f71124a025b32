"""Slot recommendations, weekly plans and their exports.

Windows here run over one account and day (at most 24 hours or ten slots) or
one account and week, so no group grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.functions import clock
from outpulse.functions.hashing import base64_sha256, hash_int, hash_uniform, jitter
from outpulse.functions.numeric import num, ratio, whole
from outpulse.operators.joins import salted_lookup
from outpulse.operators.matching import first_available, nearest_in_time
from outpulse.operators.ranking import first_per_key, top_k

DAY = ["account", "date_local"]


def quota_policy(accounts: DataFrame) -> DataFrame:
    """Daily quota per account and weekday; weekends carry the burst flag."""
    return accounts.where("is_active").select(
        "account", "account_page", "assignee", "tz", "min_hour", "max_hour", "page_state",
        F.explode(F.sequence(F.lit(0), F.lit(6))).alias("dow"), F.col("daily_quota").alias("quota"),
    ).withColumns({
        "hour_pool": F.col("quota") * 2,
        "is_burst": F.when(F.col("dow").isin(4, 5), 1).otherwise(0),
    })


def slot_recommendations(
    accounts: DataFrame, scorecard: DataFrame, prices: DataFrame, as_of: str, default_quota: int = 4
) -> DataFrame:
    """Best hours of the next 24 per account and local day, up to its quota."""
    start = F.date_trunc("hour", clock.local(F.lit(as_of).cast("timestamp_ntz"), F.coalesce("tz", F.lit("UTC")))).cast("timestamp_ntz")
    # What is known of an account's hours, at most 168, meets the account as an array; its grid comes out after the shuffle.
    hour = ["account_page", "dow", "hod"]
    known = scorecard.select(*hour, "slot_score", "rps_free").join(prices.select(*hour, "price_q", "p_buy", "rps_lcb"), hour, "full")
    values = ("slot_score", "rps_free", "price_q", "p_buy", "rps_lcb")
    known = known.groupBy("account_page").agg(F.collect_list(F.struct("dow", "hod", *values)).alias("known"))
    grid = accounts.select("account", "account_page", "is_paid", F.col("daily_quota").alias("quota"), start.alias("s"))
    grid = grid.join(known.hint("merge"), "account_page", "left").select(
        "account", "account_page", "is_paid", "quota", "known",
        F.explode(F.sequence(F.col("s"), F.col("s") + F.expr("interval 23 hours"), F.expr("interval 1 hour"))).alias("slot_at"),
    ).withColumns({"dow": clock.monday_based("slot_at"), "hod": F.hour("slot_at")})
    cell = F.get(F.filter("known", lambda x: (x.dow == F.col("dow")) & (x.hod == F.col("hod"))), F.lit(0))
    j = grid.withColumn("cell", cell).select("*", *[F.col("cell")[c].alias(c) for c in values]).drop("cell", "known")
    paid = F.col("is_paid") & F.coalesce(F.col("rps_lcb") >= F.coalesce("rps_free", F.lit(0.0)), F.lit(False))
    w = Window.partitionBy("account_page", F.to_date("slot_at")).orderBy(F.col("slot_score").desc_nulls_last(), "slot_at")
    return (
        j.withColumn("r", F.row_number().over(w)).where(F.col("r") <= F.coalesce("quota", F.lit(default_quota)))
        .select("account", "account_page", "slot_at", "dow", "hod", "slot_score", "p_buy", "rps_lcb",
                F.when(paid, "paid").otherwise("free").alias("kind"),
                F.when(paid, F.coalesce("price_q", F.lit(0.0))).otherwise(F.lit(0.0)).alias("price"))
    )


def gated_slots(slots: DataFrame, prices: DataFrame, accounts: DataFrame) -> DataFrame:
    """Slots priced by the curve; priced slots of unpaid accounts are dropped."""
    j = salted_lookup(slots.select("account_page", "slot_at", "dow", "hod"), prices.select("account_page", "dow", "hod", "price_q"), ["account_page", "dow", "hod"])
    j = salted_lookup(j, accounts.select("account_page", "is_paid"), ["account_page"])
    price = F.coalesce("price_q", F.lit(0.0))
    return j.where(F.coalesce("is_paid", F.lit(True)) | (price <= 0)).select(
        "account_page", "slot_at", "dow", "hod", F.when(price > 0, "paid").otherwise("free").alias("kind"), price.alias("price")
    )


# Hours tried when an account has no history, best first.
DEFAULT_HOURS = (21, 20, 18, 15, 12, 22, 19, 16, 13, 10, 23, 14, 17, 9, 8, 11)
MIN_GAP, MAX_GAP = 2, 6


def spaced_hours(picked: DataFrame) -> DataFrame:
    """Move picked hours to gaps of 2..6 hours inside [min_h, max_h].

    Closed form per day: a running maximum pushes slots up to the minimum gap,
    a running minimum pulls them under the maximum gap, and an end cap leaves
    room for the slots that follow.
    """
    # One order for all of them: the day is sorted once.  A number of the day comes first in it (here and in
    # ``bumped``), which spares the sort most comparisons of strings.
    in_day = Window.partitionBy("_day", *DAY).orderBy("hod", "slot_rank")
    whole_day = in_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = in_day.rowsBetween(Window.unboundedPreceding, 0)
    o = picked.withColumn("_day", F.xxhash64(*DAY))
    o = o.withColumns({"idx": F.row_number().over(in_day), "n_slots": F.count(F.lit(1)).over(whole_day)})
    h, i = F.col("hod"), F.col("idx")
    o = o.withColumn("low", F.greatest(h, MIN_GAP * i + F.max(h - MIN_GAP * i).over(so_far), F.col("min_h") + MIN_GAP * (i - 1)))
    o = o.withColumn("cap", MAX_GAP * i + F.min(F.col("low") - MAX_GAP * i).over(so_far))
    final = F.least(F.greatest("low", "min_h"), F.col("cap"), F.col("max_h") - MIN_GAP * (F.col("n_slots") - i), F.col("max_h"))
    return o.withColumn("hod", F.least(F.lit(23), F.greatest(F.lit(0), final)).cast("long")).drop("_day", "idx", "n_slots", "low", "cap")


def bumped(df: DataFrame, column: str, passes: int = 3) -> DataFrame:
    """Within a day, raise prices that round to the same amount by 0, 1, 2, ..."""
    df = df.withColumn("_day", F.xxhash64(*DAY))
    for _ in range(passes):
        w = Window.partitionBy("_day", *DAY, whole(column)).orderBy("slot_rank")
        df = df.withColumn(column, F.col(column) + F.row_number().over(w) - 1)
    return df.drop("_day")


def nearest_hour(slots: DataFrame) -> DataFrame:
    """Adds ``hod``, the usable candidate next to the anchor, of two the one with the earlier place; without an anchor the best.

    Bit h of ``usable`` and bit 23 - h of ``mirrored`` stand for hour h, so that the lowest bit left after a shift is
    the nearest hour above or below.  With 24 hours written out for every slot the generated method would be longer
    than the JVM compiles (8,000 bytes).
    """
    at = F.col("anchor")

    def steps(bits: str, shift: Column) -> Column:
        left = F.call_function("shiftright", F.col(bits), shift)
        return F.when(left > 0, F.bit_count(left.bitwiseAND(-left) - 1))

    up, down = F.col("_up"), F.col("_down")
    slots = slots.withColumns({"_up": steps("usable", at), "_down": steps("mirrored", 23 - at)})
    earlier = F.array_position("c", (at + up).cast("long")) < F.array_position("c", (at - down).cast("long"))
    above = F.when(down.isNull() | (up < down) | ((up == down) & earlier), at + up)
    hod = F.when(at.isNull(), F.when(F.col("usable") > 0, F.get("c", F.lit(0)))).otherwise(F.coalesce(above, at - down))
    return slots.withColumn("hod", hod.cast("long")).drop("_up", "_down")


def hour_scores(scores: DataFrame) -> DataFrame:
    """One row per account: scores by weekday and hour, and their sums over weekdays by hour; at most 168 entries."""
    known = scores.where(F.col("hod").isNotNull())
    cells = F.map_from_entries(F.collect_list(F.when(F.col("score").isNotNull(), F.struct("hod", "score"))))
    by_day = known.where(F.col("dow").isNotNull()).groupBy("account", "dow").agg(cells.alias("hours")).groupBy("account").agg(
        F.collect_list(F.struct("dow", "hours")).alias("by_hour"))
    overall = known.groupBy("account", "hod").agg(F.sum("score").alias("score")).groupBy("account").agg(cells.alias("all_hours"))
    return overall.join(by_day, "account", "left")


def weekly_plan(policy: DataFrame, scores: DataFrame, prices: DataFrame, weights: DataFrame | None, as_of: str) -> DataFrame:
    """Seven days of slots per account: candidate hours, anchors, nearest
    candidates, spacing, price ladder."""
    lo = F.least(F.greatest("min_hour", F.lit(0)), F.lit(23))
    hi = F.least(F.greatest("max_hour", F.lit(0)), F.lit(23))
    today = F.to_date(clock.local(F.lit(as_of).cast("timestamp_ntz"), F.col("tz")))
    days = (
        policy.where(F.col("quota") > 0)
        # Each weekday falls on exactly one of the next seven dates.
        .withColumn("date_local", F.date_add(today, F.pmod(F.col("dow") - F.weekday(today), F.lit(7))))
        .select("account", "account_page", "assignee", "tz", "page_state", "date_local", "dow", "quota", "hour_pool", "is_burst",
                F.least(lo, hi).alias("min_h"), F.greatest(lo, hi).alias("max_h"),
                hash_int("account", F.col("date_local").cast("string")).alias("seed"))
    )
    # One account is in one place from here on: its days are few rows, its hours an array, so that neither
    # the hours nor the slots below are shuffled. Equal days of a repeated account stay one, with their number.
    plan_cols = days.columns
    days = days.repartition("account").groupBy(*plan_cols).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    # Prices and weights belong to the account: its days meet them, not its slots.
    days = salted_lookup(days, prices.select("account", "p35", "p50", "p60", "p80", "p90", "price_mode"), ["account"])
    if weights is not None:
        days = salted_lookup(days, weights.select("account", "weight_price"), ["account"])
    else:
        days = days.withColumn("weight_price", F.lit(1.0))
    w = F.coalesce("weight_price", F.lit(1.0))
    mode = F.when(w >= 1.10, "premium").when(w <= 0.95, "value").otherwise(F.coalesce("price_mode", F.lit("balanced")))
    state = F.coalesce("page_state", F.lit("balance"))

    def by_state(grow, retain, other) -> Column:
        pick = [F.coalesce(*[F.col(c) for c in names], F.lit(float(d))) for names, d in (grow, retain, other)]
        return F.when(state == "grow", pick[0]).when(state == "retain", pick[1]).otherwise(pick[2])

    price = (
        F.when((mode == "premium") | (F.col("is_burst") == 1),
               by_state((["p60", "p50", "p35"], 6), (["p80", "p60", "p50"], 8), (["p90", "p80", "p60"], 9)))
        .when(mode == "value", by_state((["p35", "p50"], 5), (["p50", "p60"], 6), (["p60", "p50"], 7)))
        .otherwise(by_state((["p50", "p35"], 5), (["p60", "p50"], 6), (["p80", "p60"], 8)))
    )
    plan_cols = [*plan_cols, "price"]
    known = salted_lookup(days.select(*plan_cols[:-1], "copies", price.alias("price")), hour_scores(scores), ["account"])
    mine = F.get(F.filter("by_hour", lambda x: x.dow == F.col("dow")), F.lit(0)).hours
    # Lambdas are interpreted, entry by entry; written out for every row, 48 lookups would be more than the JVM compiles.
    def by_hour(scored: str) -> Column:
        return F.when(F.col(scored).isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at(scored, h)))

    known = known.withColumn("of_day", mine).withColumns({"by_dow": by_hour("of_day"), "by_all": by_hour("all_hours")})

    def candidate(h: int) -> Column:  # an array of it, empty where the hour is none
        s_dow, s_all = F.get("by_dow", F.lit(h)), F.get("by_all", F.lit(h))
        src = F.when(s_dow.isNotNull(), 1).when(s_all.isNotNull(), 2).otherwise(3)
        one = F.struct(src.alias("src"), (-F.coalesce(s_dow, s_all, F.lit(0.0))).alias("neg"), F.lit(h).cast("long").alias("hod"))
        return F.when(wanted(h), F.array(one)).otherwise(F.slice(F.array(one), 1, 0))

    def wanted(h: int) -> Column:
        some = F.lit(True) if h in DEFAULT_HOURS else F.get("by_dow", F.lit(h)).isNotNull() | F.get("by_all", F.lit(h)).isNotNull()
        return F.lit(h).between(F.col("min_h"), F.col("max_h")) & some

    any_hour = reduce(or_, map(wanted, sorted(range(24), key=lambda h: h not in DEFAULT_HOURS)))  # the cheap conditions first
    # Most accounts may have no history: theirs are the default hours.  Only that short list goes through a lambda, whose
    # argument would be interpreted; that there is one keeps the 24 hours in methods short enough to be compiled.
    default = F.filter(F.array(*[F.lit(h).cast("long") for h in sorted(DEFAULT_HOURS)]), lambda h: h.between(F.col("min_h"), F.col("max_h")))
    scored = F.sort_array(F.flatten(F.array(*map(candidate, range(24))))).getField("hod")
    pool = known.where(any_hour).withColumn("c", F.when(F.col("of_day").isNull() & F.col("all_hours").isNull(), default).otherwise(scored))
    hours = F.col("c")
    pool = pool.select(*plan_cols, F.when(F.col("copies") == 1, hours).otherwise(
        F.flatten(F.transform(hours, lambda h: F.array_repeat(h, F.col("copies"))))).alias("c"))
    first, last = F.element_at("c", 1), F.element_at("c", -1)
    pool = pool.withColumns({
        "a_start": F.least(F.col("max_h"), F.greatest(F.col("min_h"), first)),
        "a_end": F.greatest(F.col("min_h"), F.least(F.col("max_h"), last)),
    })
    step = whole(ratio(F.greatest(F.col("a_end") - F.col("a_start"), F.lit(2)), F.greatest(F.col("quota") - 1, F.lit(1))))
    pool = pool.withColumn("step", F.least(F.lit(6), F.greatest(F.lit(2), step)))
    # The hours that may be taken, as bits from either end.
    size = F.least(F.size("c"), F.greatest(F.col("hour_pool"), F.least(F.size("c"), F.col("quota") * 3))).cast("int")
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.cast("int"))
    bits = F.aggregate(F.slice("c", F.lit(1), size), F.lit(0).cast("long"), lambda x, h: x.bitwiseOR(bit(h)).bitwiseOR(bit(47 - h)))
    pool = pool.withColumn("bits", bits)
    pool = pool.withColumns({"usable": F.col("bits").bitwiseAND(F.lit((1 << 24) - 1)).cast("int"), "mirrored": F.shiftright("bits", 24).cast("int")}).drop("bits")
    slots = pool.withColumn("slot_rank", F.explode(F.sequence(F.lit(0), F.least(F.col("quota") - 1, F.col("max_h") - F.col("min_h")).cast("int"))))
    anchor = F.when(F.col("quota") == 1, whole((F.col("a_start") + F.col("a_end")) / 2.0)).otherwise(
        F.col("a_start") + F.col("slot_rank") * F.col("step") + F.pmod(F.col("seed") + F.col("slot_rank"), F.lit(3)) - 1
    )
    # No hour is beyond 0 and 23, so what is nearest to an anchor there is nearest to one beyond.
    anchor = F.when(anchor.isNotNull(), F.least(F.lit(23), F.greatest(F.lit(0), anchor))).cast("int")
    picked = nearest_hour(slots.withColumn("anchor", anchor)).drop("c", "usable", "mirrored", "a_start", "a_end", "step", "anchor")
    out = bumped(spaced_hours(picked), "price")
    at = (F.col("date_local").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hod").cast("int"))).cast("timestamp_ntz")
    return out.select(
        "account", "account_page", "assignee", "tz", "date_local", "dow", "slot_rank", "hod", "price", "min_h", "max_h", "quota",
        "hour_pool", "is_burst", at.alias("planned_local"), clock.to_utc(at, F.col("tz")).alias("scheduled_utc"),
    )


@dataclass(frozen=True)
class SlotPack:
    tier: str
    anchors: int
    supports: int
    spacing_minutes: int
    jitter_minutes: int


SLOT_PACKS = (SlotPack("high", 2, 4, 90, 30), SlotPack("medium", 2, 3, 120, 30), SlotPack("low", 1, 2, 180, 20))


def tier_plan(intensity: DataFrame, profile: DataFrame, candidates: DataFrame, week_start: str, k: int = 3) -> DataFrame:
    """Two anchors at least four hours apart plus spaced support slots per day,
    each with the account's best templates."""
    spark = intensity.sparkSession
    packs = spark.createDataFrame(
        [(p.tier, p.anchors, p.supports, p.spacing_minutes, p.jitter_minutes) for p in SLOT_PACKS],
        "tier string, anchors int, supports int, spacing int, jit int",
    )
    days = intensity.select("account", "tier").join(packs, "tier").withColumn(
        "slot_date", F.explode(F.sequence(F.lit(week_start).cast("date"), F.date_add(F.lit(week_start).cast("date"), 6)))
    ).withColumn("weekday", clock.sunday_based("slot_date"))
    hours = profile.select("account", "weekday", "hour", "lift", "rank_in_day")
    top = days.join(hours, ["account", "weekday"])
    day = Window.partitionBy("account", "slot_date")

    def minute(tag: str) -> Column:
        return (F.col("hour") * 60 + F.floor(hash_uniform("account", F.col("slot_date").cast("string"), "hour", F.lit(tag)) * F.col("jit"))).cast("long")

    top = top.withColumn("a1_hour", F.min(F.when(F.col("rank_in_day") == 1, F.col("hour"))).over(day))
    gap = F.abs(F.col("hour") - F.col("a1_hour"))
    apart = F.least(gap, 24 - gap) >= 4
    second = (F.col("anchors") >= 2) & (F.col("rank_in_day") > 1) & apart
    top = top.withColumn("a2", F.min(F.when(second, F.struct("rank_in_day", "hour"))).over(day))
    top = top.withColumn("a2_hour", F.col("a2.hour"))
    is_a1 = F.col("hour") == F.col("a1_hour")
    is_a2 = F.coalesce(F.col("hour") == F.col("a2_hour"), F.lit(False))
    is_sup = ~is_a1 & ~is_a2 & (F.col("rank_in_day") > F.col("anchors"))
    top = top.withColumns({
        "kind": F.when(is_a1 | is_a2, "ANCHOR").when(is_sup, "SUPPORT"),
        "minute": F.when(is_a1, minute("a1")).when(is_a2, minute("a2")).otherwise(minute("sup")),
    }).where(F.col("kind").isNotNull())
    order = Window.partitionBy("account", "slot_date", "kind").orderBy(F.col("lift").desc(), "hour")
    top = top.withColumn("kind_rank", F.row_number().over(order))
    anchors_at = F.collect_list(F.when(F.col("kind") == "ANCHOR", F.col("minute"))).over(day)  # at most two
    top = top.withColumn("anchors_at", anchors_at)

    def near(a: Column) -> Column:
        d = F.abs(F.col("minute") - a)
        return F.least(d, 1440 - d) < F.col("spacing")

    keep = (F.col("kind") == "ANCHOR") | ((F.col("kind_rank") <= F.col("supports")) & ~F.exists("anchors_at", near))
    slots = top.where(keep).select("account", "slot_date", "kind", "hour", "minute", "lift")
    pool = candidates.where(F.col("rank") <= k).groupBy("account").agg(
        F.sort_array(F.collect_list(F.struct("rank", "template"))).alias("p")  # at most k
    ).select("account", F.transform("p", lambda x: x.template).alias("templates"))
    return slots.join(pool, "account", "left")


def plan_pages(plan: DataFrame, accounts: DataFrame) -> DataFrame:
    """Plan rows with the account page, its assignee and a tracking hash."""
    page = accounts.where("is_active").select("account", "page_type", F.col("assignee").alias("current_assignee"))
    j = salted_lookup(plan, page, ["account"], "inner")
    key = F.concat("account_page", F.lit("|"), F.col("date_local").cast("string"), F.lit("|"), F.col("hod").cast("string"))
    return j.withColumn("assignee", F.coalesce("current_assignee", "assignee", F.lit("unassigned"))).drop("current_assignee").withColumn(
        "tracking_hash", base64_sha256(key)
    )


def with_overrides(pages: DataFrame, aliases: DataFrame, overrides: DataFrame) -> DataFrame:
    """Apply account aliases, then assignee overrides.

    An alias meets the override of the account it stands for before the pages do,
    so that these, many per account, are looked up and dealt by one key.
    """
    forced = overrides.select("account", F.col("assignee").alias("forced"))
    aliased = aliases.select("account", "resolved", F.coalesce("resolved", "account").alias("_target"))
    aliased = salted_lookup(aliased, forced.withColumnRenamed("account", "_target"), ["_target"]).select("account", "resolved", "forced")
    others = forced.join(aliases.select("account"), "account", "left_anti").select("account", F.lit(None).cast("string").alias("resolved"), "forced")
    j = salted_lookup(pages, aliased.unionByName(others), ["account"]).withColumn("account", F.coalesce("resolved", "account")).drop("resolved")
    return j.withColumns({
        "account_page": F.concat_ws("__", "account", "page_type"),
        "assignee": F.coalesce("forced", "assignee", F.lit("unassigned")),
    }).drop("forced")


def plan_audit(plan: DataFrame, policy: DataFrame, scores: DataFrame, prices: DataFrame, weights: DataFrame) -> DataFrame:
    dow_score = scores.groupBy("account", "dow").agg(F.sum("score").alias("dow_score"))
    p = plan.drop("quota", "hour_pool", "is_burst")
    p = salted_lookup(p, policy.select("account", "dow", "quota", "hour_pool", "is_burst"), ["account", "dow"])
    p = salted_lookup(p, weights, ["account"])
    p = salted_lookup(p, prices, ["account"])
    return salted_lookup(p, dow_score, ["account", "dow"])


def feasibility_alerts(plan: DataFrame, policy: DataFrame) -> DataFrame:
    """Account-days whose window is too narrow for the quota at the minimum gap."""
    days = plan.select("account", "date_local", "dow", "min_h", "max_h").distinct()
    j = salted_lookup(days, policy.select("account", "dow", "quota"), ["account", "dow"])
    return j.withColumns({
        "window_width": F.col("max_h") - F.col("min_h"), "width_needed": F.greatest(F.lit(0), MIN_GAP * (F.col("quota") - 1)),
    }).where(F.col("window_width") < F.col("width_needed"))


def gap_violations(plan: DataFrame) -> DataFrame:
    """Planned neighbours closer than two hours, or more than six apart."""
    w = Window.partitionBy(*DAY).orderBy("hod", "slot_rank")
    o = plan.select("account", "date_local", "min_h", "max_h", F.col("hod").alias("curr_h"),
                    F.lag("hod").over(w).alias("prev_h"), F.lead("hod").over(w).alias("next_h"))
    tight = o.where(F.col("curr_h") - F.col("prev_h") < MIN_GAP).select(
        F.lit("MIN_GAP_LT_2H").alias("issue"), "*", (F.col("curr_h") - F.col("prev_h")).alias("gap_h"))
    wide = o.where((F.col("next_h") - F.col("curr_h") > MAX_GAP) & F.col("curr_h").between(F.col("min_h"), F.col("max_h"))).select(
        F.lit("MAX_GAP_GT_6H_IN_WINDOW").alias("issue"), "*", (F.col("next_h") - F.col("curr_h")).alias("gap_h"))
    return tight.unionByName(wide)


@dataclass(frozen=True)
class WindowSettings:
    """Comma-separated times, as they are stored in the settings table."""

    drip: str = "10:30|MM,14:00|Wall,19:15|MM"
    renewal: str = "11:00,20:00"
    link_drop: str = "12:00-14:00,17:30-19:00"
    jitter: int = 45


def _at(day: str, hhmm: Column) -> Column:
    parts = F.split(hhmm, ":")
    minutes = (F.get(parts, F.lit(0)).cast("int") * 60 + F.get(parts, F.lit(1)).cast("int")).cast("int")
    return (F.col(day).cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)).cast("timestamp_ntz")


def side_windows(accounts: DataFrame, as_of: str, settings: WindowSettings = WindowSettings()) -> DataFrame:
    """Drip, renewal and link-drop moments of the next seven days."""
    today = F.to_date(clock.local(F.lit(as_of).cast("timestamp_ntz"), F.col("tz")))
    days = accounts.where("is_active").select(
        "account", "tz", "renew_on_pct", F.explode(F.sequence(today, F.date_add(today, 6))).alias("d"))

    def moved(df: DataFrame, kind: Column, base: Column, minutes: Column) -> DataFrame:
        return df.select("account", "tz", kind.alias("kind"), (base + F.make_dt_interval(mins=minutes.cast("int"))).cast("timestamp_ntz").alias("planned_local"))

    j = settings.jitter
    drip = days.withColumn("tok", F.explode(F.split(F.lit(settings.drip), ","))).withColumns({
        "hhmm": F.get(F.split("tok", r"\|"), F.lit(0)), "ch": F.get(F.split("tok", r"\|"), F.lit(1))})
    drip = moved(drip, F.when(F.col("ch") == "MM", "drip_mm").otherwise("drip_wall"), _at("d", F.col("hhmm")),
                 jitter(-j, j, "account", F.col("d").cast("string"), F.lit("DRIP"), "hhmm", "ch"))
    renew = days.where(F.col("renew_on_pct") > 0).withColumn("hhmm", F.explode(F.split(F.lit(settings.renewal), ",")))
    renew = moved(renew, F.lit("renewal"), _at("d", F.col("hhmm")), jitter(-j, j, "account", F.col("d").cast("string"), F.lit("RENEW"), "hhmm"))
    link = days.withColumn("tok", F.explode(F.split(F.lit(settings.link_drop), ","))).withColumns({
        "s": _at("d", F.get(F.split("tok", "-"), F.lit(0))), "e": _at("d", F.get(F.split("tok", "-"), F.lit(1)))})
    width = F.greatest(clock.whole_units("MINUTE", "s", "e"), F.lit(1))
    link = moved(link, F.lit("link_drop"), F.col("s"), F.pmod(hash_int("account", F.date_format("s", "yyyy-MM-dd HH:mm"), F.lit("link")), width))
    u = drip.unionByName(renew).unionByName(link)
    return u.select("account", "kind", F.to_date("planned_local").alias("date_local"), F.hour("planned_local").alias("hod"), "planned_local",
                    clock.to_utc("planned_local", F.col("tz")).alias("scheduled_utc"))


# Follow-up offsets in minutes per price level; step 0 precedes the slot.
BUMP_RULES = (("teaser", 1, 20, 45), ("mid", 0, -20, -15), ("mid", 1, 15, 20), ("mid", 2, 45, 45),
              ("premium", 0, -20, -15), ("premium", 1, 20, 30), ("premium", 2, 40, 55))


def followup_bumps(plan: DataFrame, prices: DataFrame, jitter_minutes: int = 45) -> DataFrame:
    """Follow-up moments around priced slots, by price level."""
    p = salted_lookup(plan.where(F.col("price") > 0), prices.select("account", "p50", "p90"), ["account"])
    level = F.when(F.col("price") >= F.coalesce("p90", "price"), "premium").when(F.col("price") >= F.coalesce("p50", "price"), "mid").otherwise("teaser")
    rules = p.sparkSession.createDataFrame(BUMP_RULES, "level string, step int, low int, high int")
    b = p.withColumn("level", level).join(F.broadcast(rules), "level")  # seven fixed rules
    key = ["account", F.col("date_local").cast("string"), "slot_rank", "step"]
    pick = F.col("low") + F.pmod(hash_int(*key), F.col("high") - F.col("low") + 1)
    at = (F.col("planned_local") + F.make_dt_interval(mins=(pick + jitter(-jitter_minutes, jitter_minutes, *key, F.lit("J"))).cast("int"))).cast("timestamp_ntz")
    return b.select(
        "account", "date_local", "slot_rank", "level", "step",
        F.when(F.col("step") == 0, "pre_teaser").otherwise("followup").alias("activity"), at.alias("planned_local"),
        clock.to_utc(at, F.col("tz")).alias("scheduled_utc"),
    )


def my_day(plan: DataFrame, bumps: DataFrame, windows: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Everything planned for each account's local today, in one list."""
    a = accounts.select("account", "account_page", F.to_date(clock.local(F.lit(as_of).cast("timestamp_ntz"), F.col("tz"))).alias("today"))
    none = F.lit(None)
    rows = (
        plan.select("account", F.lit("paid").alias("kind"), "planned_local", "price", F.col("slot_rank").cast("int").alias("slot_rank"))
        .unionByName(bumps.select("account", F.lit("followup").alias("kind"), "planned_local", none.cast("double").alias("price"), none.cast("int").alias("slot_rank")))
        .unionByName(windows.select("account", "kind", "planned_local", none.cast("double").alias("price"), none.cast("int").alias("slot_rank")))
    )
    j = salted_lookup(rows, a, ["account"], "inner").where(F.to_date("planned_local") == F.col("today"))
    return j.select(
        "account_page", "kind", F.when(F.col("kind").isin("drip_wall", "link_drop"), "Wall").otherwise("MM").alias("channel"),
        "planned_local", F.hour("planned_local").alias("hod"), "price", "slot_rank",
        F.date_format("planned_local", "EEE MMM dd, hh:mm a").alias("shown_as"),
    )


def plan_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy(*DAY).agg(F.count(F.lit(1)).alias("slots"), F.min("hod").alias("first_hour"), F.max("hod").alias("last_hour"), F.avg("price").alias("avg_price"))


def daily_brief(accounts: DataFrame, local: DataFrame, facts: DataFrame, templates: DataFrame, as_of: str, rest_days: int = 28) -> DataFrame:
    """Best hours, price band and suggested copy per account."""
    age = clock.whole_units("DAY", "local_at", clock.moment(as_of))
    hours = local.groupBy("account", "hod").agg(F.sum(num("earnings") * F.exp(-age / 60.0)).alias("s")).groupBy("account").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(F.col("s").alias("s"), (-F.col("hod")).alias("neg"))), asc=False), 1, 5).alias("h"))
    band = facts.where(clock.within_days("sent_at", as_of, 60)).groupBy("account").agg(
        F.percentile_approx(num("price"), F.array(F.lit(0.4), F.lit(0.5), F.lit(0.7)), F.lit(10000)).alias("q"))
    cap = facts.where(clock.within_days("sent_at", as_of, 180)).groupBy("account", "template").agg(
        F.sum("earnings").cast("double").alias("revenue"), F.max("sent_date").alias("last_date"))
    # All copy an account owns or has ever sent can be suggested; never sent is rested, without revenue.
    known = templates.select(F.col("owned_by").alias("account"), "template").unionByName(facts.select("account", "template")).distinct()
    cap = known.join(cap, ["account", "template"], "left").withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))
    cap = salted_lookup(cap, templates.select("template", "category"), ["template"], "inner")
    rested = F.coalesce(clock.days_between(clock.day(as_of), "last_date") >= rest_days, F.lit(True)).cast("int")
    best = top_k(cap.withColumn("rested", rested), ["account"], [F.col("rested").desc(), F.col("revenue").desc(), F.col("template")], 10)
    best = best.groupBy("account").agg(F.sort_array(F.collect_list(F.struct("rank", "template", "category", "revenue"))).alias("suggestions"))
    recent = facts.where(clock.within_days("sent_at", as_of, 7)).select("account", "template").distinct()
    # Every template of the week is kept; the list is per account and week.
    avoid = recent.groupBy("account").agg(F.count(F.lit(1)).alias("avoid_count"), F.sort_array(F.collect_list("template")).alias("avoid"))
    out = accounts.select("account", "assignee", "page_state")
    for side in (hours, band, best, avoid):
        out = out.join(side, "account", "left")
    return out.select(
        "account", "assignee", "page_state", F.transform(F.coalesce("h", F.array().cast("array<struct<s:double,neg:int>>")), lambda x: -x.neg).alias("best_hours"),
        F.struct(F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75")).alias("price_band"), "suggestions",
        F.coalesce("avoid_count", F.lit(0)).alias("avoid_count"), F.coalesce("avoid", F.array().cast("array<string>")).alias("avoid"),
    )


def brief_rows(brief: DataFrame, users: DataFrame, user: str) -> DataFrame:
    """Brief flattened for one user: their own accounts, or all if allowed."""
    me = users.where(F.lower("email") == user.lower()).select(F.col("assignee").alias("mine"), F.coalesce("can_view_all", F.lit(False)).alias("all_rows"))
    all_rows = F.coalesce(me.agg(F.max("all_rows")).scalar(), F.lit(False))
    own = brief.join(me.select("mine").distinct(), F.col("assignee") == F.col("mine"), "left").where(all_rows | F.col("mine").isNotNull()).drop("mine")
    return own.select(
        "assignee", "account", "page_state", "price_band.p25", "price_band.p50", "price_band.p75",
        *[F.get("best_hours", F.lit(i)).alias(f"hod{i + 1}") for i in range(5)], F.explode_outer("suggestions").alias("s"),
    ).select("*", F.col("s.template").alias("template"), F.col("s.category").alias("category"), F.col("s.revenue").alias("revenue"),
             F.col("s.rank").alias("suggestion_rank")).drop("s")


# Price steps per tier and page type (best price, step).
PRICE_BANDS = {("high", "main"): (38.0, 3.0), ("high", "vip"): (50.0, 5.0), ("medium", "main"): (24.0, 2.0),
               ("medium", "vip"): (32.0, 3.0), ("low", "main"): (14.0, 1.5), ("low", "vip"): (19.0, 2.0)}
LADDER = (-1.0, 0.0, 1.0, 2.0, -2.0)  # steps from the best price by position; the third is the canonical one
FALLBACKS = {"main": ("FALLBACK_001", 9.99), "vip": ("FALLBACK_002", 14.99), "free": ("FALLBACK_003", None)}  # no price: the default one


def schedule_export(ranked: DataFrame, templates: DataFrame, accounts: DataFrame, blocked_words: tuple[str, ...], jitter_minutes: int = 10,
                    blocked_levels: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Best compliant template per slot, or the fallback of its page type; five price steps and
    a jittered send time; details as JSON.

    Copy is not compliant where it has a blocked word, or where its content level (column ``level``
    of ``templates``, needed only then) is blocked for the page type.
    """
    spark = ranked.sparkSession
    bands = spark.createDataFrame([(t, p, b, s) for (t, p), (b, s) in PRICE_BANDS.items()], "tier string, page_type string, best_price double, step double")
    falls = spark.createDataFrame([(p, t, x) for p, (t, x) in FALLBACKS.items()], "page_type string, fall_template string, fall_price double")
    level = F.col("level") if blocked_levels else F.lit(None).cast("string")
    t = templates.select("template", F.substring("body", 1, 100).alias("preview"), F.lower("body").rlike("|".join(blocked_words)).alias("blocked"), level.alias("level"))
    best = salted_lookup(ranked.where(F.col("rank") == 1), t, ["template"])
    best = salted_lookup(best, accounts.select("account", "tier", "assignee"), ["account"], "inner")
    best = best.join(bands, ["tier", "page_type"], "left").join(falls, "page_type", "left")
    blocked = F.coalesce("blocked", F.lit(False))
    for page_type, barred in blocked_levels:
        blocked = blocked | F.coalesce((F.col("page_type") == page_type) & (F.col("level") == barred), F.lit(False))
    ok = ~blocked & F.col("cooldown_ok") & F.col("dedupe_ok")
    reason = F.when(blocked, "compliance_filtered").when(~F.col("cooldown_ok"), "cooldown_override").when(
        ~F.col("dedupe_ok"), "dedup_override").otherwise(F.col("reason"))
    minute = jitter(-jitter_minutes, jitter_minutes, "account_page", F.date_format("date_local", "yyyyMMdd"), "hod")
    at = F.col("date_local").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hod").cast("int"), mins=minute.cast("int"))
    rows = best.select(
        "account", "account_page", "page_type", "assignee", "date_local", "hod", "slot_rank", at.alias("send_at"),
        F.when(ok, F.col("template")).otherwise(F.col("fall_template")).alias("template"), "preview",
        F.coalesce("best_price", "fall_price", F.lit(19.99)).alias("price0"), F.coalesce("step", F.lit(1.0)).alias("step"),
        F.coalesce("score_100", F.lit(0.0)).alias("score"), reason.alias("reason"),
        F.to_json(F.struct("category", "cooldown_ok", "dedupe_ok", "cold_start", "days_since_used")).alias("details"),
    )
    step = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(off).alias("off")) for i, off in enumerate(LADDER)]))
    return rows.withColumn("l", step).select(
        "account", "page_type", "assignee", "date_local", "hod", "slot_rank", F.date_format("date_local", "EEE").alias("day_name"),
        F.concat(F.lit("Slot "), (F.col("slot_rank") + 1).cast("string")).alias("slot"), F.date_format("send_at", "HH:mm").alias("send_time"),
        F.round(F.col("price0") + F.col("l.off") * F.col("step"), 2).alias("price"), F.col("l.position").alias("ladder_position"),
        "template", "preview", F.round("score").alias("score"), "reason",
        F.when(F.col("slot_rank") == 0, "Prime slot").when(F.col("slot_rank") == 1, "Secondary peak").otherwise("Coverage slot").alias("slot_note"), "details",
    )


def send_links(scheduled: DataFrame, sends: DataFrame, as_of: str, days: int = 180) -> DataFrame:
    """Scheduled send to the actual one: by tracking hash, else by template,
    else by equal price within [-1 day, +14 days]; the nearest in time."""
    s = sends.where(clock.within_days("sent_at", as_of, days)).select("account", "message_id", "sent_at", "template", "price", "earnings", "sent", "purchased")
    cents = s.withColumn("price_key", whole(num("price") * 100))
    args = dict(left_id="schedule_id", left_at="logged_at", right_at="sent_at", right_id="message_id")
    by_hash = nearest_in_time(scheduled.withColumn("template", F.col("tracking")), s, ["account", "template"], **args)
    by_template = nearest_in_time(scheduled, s, ["account", "template"], **args)
    by_price = nearest_in_time(scheduled.withColumn("price_key", whole(num("price") * 100)), cents, ["account", "price_key"],
                               before="1 day", after="14 days", **args)
    keep = F.struct(*[F.col(f"match.{c}").alias(c) for c in ("id", "at", "earnings", "sent", "purchased")]).alias("match")
    found = first_available([("hash", by_hash.select("schedule_id", keep)), ("template", by_template.select("schedule_id", keep)),
                             ("time_price", by_price.select("schedule_id", keep))], "schedule_id")
    return scheduled.join(found, "schedule_id").select(
        "schedule_id", "account", "assignee", "logged_at", "matched_by", F.col("match.id").alias("message_id"), F.col("match.at").alias("sent_at"),
        F.col("match.earnings").alias("earnings"), F.col("match.sent").alias("sent"), F.col("match.purchased").alias("purchased"))
