"""What is many times the input (hours, slots, ranks) comes out after the shuffle, not before it."""

import datetime as dt
import random
import re

import pytest

from outpulse.catalog import planning
from outpulse.operators import joins, ranking
from outpulse.plans import advice, rank, slots

AS_OF = "2024-01-31 00:00:00"


@pytest.fixture
def joined(spark):
    """Joins by shuffle, as on large tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def dealt(df) -> list[str]:
    """The keys of every exchange, without the numbers of the columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"hashpartitioning\((.*), \d+\)", plan)]


def policy(spark, repeats=1):
    rows = [(f"a{i}", f"a{i}__main", "S1", "UTC", 8, 20, "grow", dow, 4, 8, 0) for i in range(3) for dow in range(7)] * repeats
    return spark.createDataFrame(
        rows, "account string, account_page string, assignee string, tz string, min_hour long, max_hour long, page_state string, dow int, quota long, hour_pool long, is_burst int")


def plan(spark, repeats=1):
    scores = spark.createDataFrame([("a0", 2, 9, 5.0), ("a0", 2, 18, 7.0), ("a0", 3, 12, 1.0), ("a1", None, 12, 1.0)], "account string, dow int, hod int, score double")
    prices = spark.createDataFrame([("a0", 1.0, 2.0, 3.0, 4.0, 5.0, "balanced")], "account string, p35 double, p50 double, p60 double, p80 double, p90 double, price_mode string")
    return slots.weekly_plan(policy(spark, repeats), scores, prices, None, AS_OF)


def test_week_is_dealt_by_account_only(joined):
    df = plan(joined)
    assert not [k for k in dealt(df) if "date_local" in k]
    days = df.where("account = 'a0' AND date_local = '2024-01-31'").orderBy("slot_rank").collect()  # a Wednesday
    assert [r.dow for r in days] == [2] * 4
    assert df.count() == 3 * 7 * 4 and df.where("hod IS NULL OR price IS NULL").count() == 0


def test_week_of_a_repeated_account_is_one(joined):
    assert plan(joined, repeats=2).count() == plan(joined).count()


def test_ranks_of_rare_values_are_not_repeated(spark, monkeypatch):
    monkeypatch.setattr(ranking, "HOT_ROWS", 10)
    df = spark.range(500).selectExpr("id", "id % 3 AS k", "id div 2 AS v")
    got = ranking.with_ranks(df, [("r", ["k"], "v")], buckets=4)
    assert "explode" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert got.count() == 500


def test_hours_of_a_day_are_not_dealt(joined):
    accounts = joined.createDataFrame([(f"a{i}", f"a{i}__main", "UTC", True, 4) for i in range(3)], "account string, account_page string, tz string, is_paid boolean, daily_quota long")
    card = joined.createDataFrame([("a0__main", 2, 9, 5.0, 0.1), ("a0__main", None, 9, 9.0, 0.1)], "account_page string, dow int, hod int, slot_score double, rps_free double")
    prices = joined.createDataFrame([("a0__main", 2, 9, 20.0, 0.2, 3.0), ("a0__main", 2, 10, 30.0, 0.2, 3.0)], "account_page string, dow int, hod int, price_q double, p_buy double, rps_lcb double")
    df = slots.slot_recommendations(accounts, card, prices, AS_OF)
    assert not [k for k in dealt(df) if "slot_at" in k or "_w" in k]
    best = df.where("account = 'a0' AND slot_score IS NOT NULL").collect()
    assert [(r.hod, r.slot_score, r.price, r.kind) for r in best] == [(9, 5.0, 20.0, "paid")]
    assert df.count() == 12


def test_candidates_at_slots_are_not_dealt_by_style(joined):
    at = dt.datetime(2024, 1, 31, 9)
    grid = joined.createDataFrame([("p", at, 2, 9, 10.0), ("q", at, 2, 9, 10.0)], "account_page string, slot_at timestamp_ntz, dow int, hod int, price double")
    pool = joined.createDataFrame(
        [("p", "t1", "short", "none", True, False, False, None, True), ("p", "t2", "short", "none", None, False, False, None, True)],
        "account_page string, template string, length_bin string, emoji_bin string, has_cta boolean, has_urgency boolean, ends_with_question boolean, last_used_at timestamp_ntz, cooldown_ok boolean")
    style = joined.createDataFrame([("p", 2, 9, "short", "none", True, False, False, 0.5), ("p", 2, 9, "long", "none", True, False, False, 0.1)],
                                   "account_page string, dow int, hod int, length_bin string, emoji_bin string, has_cta boolean, has_urgency boolean, ends_with_question boolean, lift_clamped double")
    stats = joined.createDataFrame([("p", "t1", 100.0, 10.0)], "account_page string, template string, decayed_sent double, decayed_bought double")
    priors = joined.createDataFrame([("p", 0.1)], "account_page string, mu_buy double")
    dm = joined.createDataFrame([("p", 2, 9, 40)], "account_page string, dow int, hod int, sent long")
    df = rank.preliminary_scores(grid, pool, style, stats, priors, dm, AS_OF)
    assert not [k for k in dealt(df) if "has_cta" in k]
    got = {r.template: (round(r.style_score, 9), round(r.p_buy, 9)) for r in df.collect()}
    assert got == {"t1": (0.05, 0.1), "t2": (0.0, 0.1), "q|fallback": (0.0, 0.08)}


def test_pairs_at_slots_are_dealt_by_account_only(joined):
    perf = joined.createDataFrame(
        [("a0", "t1", 1.0, 0.0, 0.0, 0.5, 1.0, False, 0.1, 0.9, 9), ("a0", "t2", 0.0, 0.0, 0.0, 0.5, 1.0, False, 0.1, 0.1, 9), ("a9", "t1", 0.0, 0.0, 0.0, 0.5, 1.0, False, 0.1, 0.1, 9)],
        "account string, template string, rps_z double, open_rate_z double, conversion_z double, rps double, novelty double, cold_start boolean, exploration double, rps_pct double, days_since_used int")
    facts = joined.createDataFrame([("a0", "t1", dt.datetime(2024, 1, 2), dt.date(2024, 1, 2), 10, 1, 20.0, 20.0)],
                                   "account string, template string, sent_at timestamp_ntz, sent_date date, sent long, purchased long, price double, earnings double")
    accounts = joined.createDataFrame([(f"a{i}", "main", "grow") for i in range(3)], "account string, page_type string, page_state string")
    timing = joined.createDataFrame([("a0", 2, 9, 1.0)], "account string, dow int, hod int, score double")
    copy = joined.createDataFrame([("t1", "x"), ("t2", "y")], "template string, category string")
    df = rank.weighted_ranking(plan(joined).select("account", "date_local", "dow", "slot_rank", "hod"), perf, facts, accounts, timing, copy, AS_OF)
    # One exchange per side is narrow: spans are counted where the rows are.
    assert not [k for k in dealt(df) if re.search(r"\baccount, date_local, hod\b", k)]
    rows = df.collect()
    assert len(rows) == 7 * 4 * 2 and {r.account for r in rows} == {"a0"}
    assert {r.categories for r in rows} == {2}
    assert {round(r.score_100, 6) for r in rows} <= {0.0, 100.0}


def test_hours_of_the_next_day_are_not_dealt(joined):
    store = joined.range(30).selectExpr(
        "concat('p', id % 2) AS account_page", "concat('t', id) AS template", "named_struct('eligible', true) AS cooldown",
        "named_struct('hours_since_use', 24, 'best_hour', 12) AS timing", "named_struct('rps_pct', (id div 4) / 10.0D) AS scores",
        "named_struct('ucb', 1.0D) AS exploration", "named_struct('stability', 0.5D, 'rps_smoothed', 1.0D, 'confidence', 0.5D, 'sends_30d', 9L) AS performance")
    df = rank.slot_ranking(store, AS_OF, rank.RankerParams(epsilon_percent=0))
    assert not [k for k in dealt(df) if "slot_at" in k]
    rows = df.where("hour(slot_at) = 0 AND slot_at = '2024-01-31 00:00:00' AND account_page = 'p0'").orderBy("rank").collect()
    # Fifteen templates in pairs of equal scores, the last alone at the top.
    assert [round(r.score_pct * 14) for r in rows] == [14, 12, 12, 10, 10, 8, 8, 6, 6, 4]
    assert df.count() == 2 * 25 * 10


def test_packed_lookup_is_a_left_join(joined):
    left = joined.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", None), ("b", 1), (None, 1)], "k string, h long")
    right = joined.createDataFrame([("a", 1, 5.0), ("a", 1, None), ("a", None, 7.0), (None, 1, 8.0), ("c", 1, 9.0)], "k string, h int, v double")
    for keys in (["h"], ["h", "g"]):
        l, r = left.withColumn("g", left.h), right.withColumn("g", right.h)
        l, r = (l, r) if len(keys) > 1 else (l.drop("g"), r.drop("g"))
        want, got = l.join(r, ["k", *keys], "left"), joins.packed_lookup(l, r, ["k"], keys)
        key = lambda row: str(row.asDict())
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols and sorted(map(key, got.select(cols).collect())) == sorted(map(key, want.select(cols).collect()))
    assert "k" in dealt(got)  # the left rows are dealt by the first key alone


def test_week_with_scores_is_dealt_by_few_keys(joined):
    p = plan(joined)
    hod = p.where("account = 'a0' AND date_local = '2024-01-31' AND slot_rank = 0").first().hod
    projections = joined.createDataFrame([("a0__main", dt.datetime(2024, 1, 31, hod), 1.0, 30.0)], "account_page string, slot_at timestamp_ntz, lift double, opportunity double")
    volume = joined.createDataFrame([(f"a{i}", 3) for i in range(3)], "account string, recommended int")
    weekday = joined.createDataFrame([(f"a{i}", d, 2) for i in range(2) for d in range(1, 8)], "account string, weekday int, weekday_volume int")
    timing = joined.createDataFrame([("a0", 10, hod, 0.5)], "account string, risk int, common_hour int, common_ratio double")
    df = advice.enhanced_plan(p, volume, weekday, timing, projections)
    joins_on = re.findall(r"SortMergeJoin \[(.*?)\]", re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString()))
    assert joins_on and not [k for k in joins_on if "weekday" in k or "hod" in k]
    rows = df.collect()
    assert len(rows) == p.count()
    found = [r for r in rows if r.opportunity is not None]
    assert {(r.account, str(r.date_local), r.hod) for r in found} == {("a0", "2024-01-31", hod)} and {r.slot_risk for r in found} == {"HIGH_RISK"}
    assert {r.volume_score for r in rows if r.account == "a2"} == {1.0}


def test_copy_of_other_accounts_is_found_without_dealing_hours(joined):
    at = lambda h: dt.datetime(2024, 1, 31, h)
    pre = joined.createDataFrame(
        [("p", at(3), "t", 5.0, 1.0), ("q", at(9), "u", 5.0, 1.0), ("q", at(9), "t", 1.0, 1.0), ("q", at(10), "t", 9.0, 1.0), ("q", at(12), "t", 1.0, 1.0), ("q", at(12), "u", 2.0, 1.0),
         ("r", at(17), "t", 1.0, 1.0), ("r", at(17), "v", 2.0, 1.0), ("s", None, "t", 1.0, 1.0)],
        "account_page string, slot_at timestamp_ntz, template string, preliminary double, rps_eb double")
    df = rank.diverse_ranking(pre, stable=True)
    # Rows are dealt by template, once; the rank in the day is taken there.
    assert not [k for k in dealt(df) if "hour_no" in k or "to_date" in k or "cast(slot_at as date)" in k]
    got = {(r.account_page, r.slot_at and r.slot_at.hour, r.template): (r.conflict, r.same_day_rank) for r in df.collect()}
    assert got == {
        ("p", 3, "t"): (False, 1), ("q", 9, "u"): (False, 1), ("q", 9, "t"): (True, 2), ("q", 10, "t"): (False, 1), ("q", 12, "t"): (False, 3),
        ("q", 12, "u"): (False, 2), ("r", 17, "t"): (False, 1), ("r", 17, "v"): (False, 1), ("s", None, "t"): (False, 1)}


def test_overrides_of_aliases_meet_before_the_pages(joined):
    pages = joined.createDataFrame([("a", "main", "x"), ("a", "main", "x"), ("b", "vip", None), ("c", "vip", "z"), ("d", "free", "w"), (None, "free", "v")], "account string, page_type string, assignee string")
    aliases = joined.createDataFrame([("a", "c"), ("b", None), ("e", "a"), (None, "a")], "account string, resolved string")
    overrides = joined.createDataFrame([("c", "lead"), ("b", "boss"), ("a", "none"), (None, "nobody")], "account string, assignee string")
    df = slots.with_overrides(pages, aliases, overrides)
    assert not [k for k in dealt(df) if "coalesce(resolved, account)" in k]
    got = sorted((str(r.account), r.account_page, r.assignee) for r in df.collect())
    assert got == [("None", "free", "v"), ("b", "b__vip", "boss"), ("c", "c__main", "lead"), ("c", "c__main", "lead"), ("c", "c__vip", "lead"), ("d", "d__free", "w")]


def test_hours_of_a_week_are_not_interpreted(joined):
    text = plan(joined)._jdf.queryExecution().optimizedPlan().toString()
    # Lambdas are left for copies of a repeated account and the hours of its weekday alone.
    assert "arraymin" not in text.lower() and "array_min" not in text.lower()
    days = [(r.slot_rank, r.hod) for r in plan(joined).where("account = 'a0' AND date_local = '2024-01-31'").orderBy("slot_rank").collect()]
    assert len(days) == 4 and len({h for _, h in days}) == 4


def test_slots_of_the_week_are_compiled(joined):
    """The JVM interprets methods of more than 8,000 bytes, whatever the rows."""
    df = plan(joined)
    df.collect()
    debug = getattr(getattr(joined._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    found = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    assert found.length() > 0 and max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.length())) <= 8000


def test_nearest_hour_is_that_of_all_candidates(spark):
    rnd, rows, want = random.Random(3), [], {}
    for n in range(400):
        c = rnd.sample(range(24), rnd.choice([0, 1, 3, 16, 24]))
        anchor, size = rnd.choice([None, *range(24)]), rnd.choice([1, 6, 24])
        places = [c.index(h) + 1 if h in c else 0 for h in range(24)]
        near = [h for h in range(24) if 0 < places[h] <= size]
        rows.append((n, c, sum(1 << h for h in near), sum(1 << 23 - h for h in near), anchor))
        want[n] = min(near, key=lambda h: (0 if anchor is None else abs(h - anchor), places[h]), default=None)
    df = spark.createDataFrame(rows, "n int, c array<long>, usable int, mirrored int, anchor int")
    assert {r.n: r.hod for r in slots.nearest_hour(df).collect()} == want


def test_what_belongs_to_a_pair_is_worked_out_before_its_slots(joined):
    perf = joined.createDataFrame(
        [("a0", f"t{i}", 0.1 * i, 0.0, 0.0, 0.5, 1.0, False, 0.1, 0.5, 9) for i in range(4)],
        "account string, template string, rps_z double, open_rate_z double, conversion_z double, rps double, novelty double, cold_start boolean, exploration double, rps_pct double, days_since_used int")
    facts = joined.createDataFrame([("a0", "t1", dt.datetime(2024, 1, 2), dt.date(2024, 1, 2), 10, 1, 20.0, 20.0)],
                                   "account string, template string, sent_at timestamp_ntz, sent_date date, sent long, purchased long, price double, earnings double")
    accounts = joined.createDataFrame([("a0", "main", "grow")], "account string, page_type string, page_state string")
    timing = joined.createDataFrame([("a0", 2, 9, 1.0)], "account string, dow int, hod int, score double")
    copy = joined.createDataFrame([("t0", "x"), ("t1", "y"), ("t2", None), ("t3", "x")], "template string, category string")
    df = rank.weighted_ranking(plan(joined).select("account", "date_local", "dow", "slot_rank", "hod"), perf, facts, accounts, timing, copy, AS_OF)
    above = df._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[0].lower()
    assert "date_format" not in above and "map(" not in above and "distinct" not in above
    rows = df.collect()
    assert {r.categories for r in rows} == {2} and len(rows) == 7 * 4 * 4


def test_only_accounts_with_copy_are_planned_to_rank(spark, monkeypatch):
    sends = spark.createDataFrame([("a1",), ("a1",)], "account string")
    every = spark.createDataFrame([(f"a{i}",) for i in range(5)], "account string")
    monkeypatch.setattr(planning.rk, "performance", lambda spark, d: sends)
    monkeypatch.setattr(planning.src, "accounts", lambda spark, d: every)
    monkeypatch.setattr(planning, "week_of", lambda spark, d, accounts: accounts)
    folder = f"nowhere-{id(sends)}"
    assert [r.account for r in planning.plan_to_rank(spark, folder).collect()] == ["a1"]
    assert planning.plan(spark, folder).count() == 5
    assert planning.plan_to_rank(spark, folder).count() == 5  # the stored week is read
