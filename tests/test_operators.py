"""Skew-safe operators against plain window or brute-force answers."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from outpulse.operators import joins, matching, ordered, ranking, upsert
from outpulse.plans import rank, slots


def skewed(spark, rows=4000):
    """A third of the rows share a key, a third share a value, some are NULL."""
    return spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 3 == 1, 0.0).when(F.col("id") % 41 == 0, None).otherwise((F.col("id") * 7919 % 1009) / 10.0).alias("v"),
    )


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("hot_rows", [10**9, 10])
def test_ranks_equal_plain_window(spark, monkeypatch, keys, descending, hot_rows):
    monkeypatch.setattr(ranking, "HOT_ROWS", hot_rows)  # 10: every heavy value is salted
    df = skewed(spark).where("v IS NOT NULL") if descending else skewed(spark)
    got = ranking.with_ranks(df, [("r", keys, "v")], buckets=16, salts=4, descending=descending)
    w = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(F.col("v").desc() if descending else F.col("v").asc_nulls_first())
    whole = Window.partitionBy(*(keys or [F.lit(1)]))
    want = df.select("id", F.rank().over(w).cast("long").alias("e"), F.count(F.lit(1)).over(whole).alias("n"))
    bad = got.join(want, "id").where("NOT (r_rank <=> e AND r_n <=> n)").count()
    assert bad == 0 and got.count() == df.count()


def test_percent_rank(spark):
    df = skewed(spark)
    got = ranking.with_percent_ranks(df, [("p", ["k"], "v")])
    want = df.select("id", F.percent_rank().over(Window.partitionBy("k").orderBy("v")).alias("e"))
    assert got.join(want, "id").where("abs(p - e) > 1e-12").count() == 0


def test_top_k_limits_before_the_shuffle(spark):
    df = ranking.top_k(skewed(spark), ["k"], [F.col("v").desc(), F.col("id")], 2)
    assert df.groupBy("k").count().where("count > 2").count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # partial and final


def test_salted_lookup_beyond_the_broadcast_limit(spark):
    left = skewed(spark)
    right = left.groupBy("k").agg(F.max("v").alias("top"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        salted = joins.salted_lookup(left, right, ["k"], salts=8)
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
        plain = left.join(right, "k", "left")
        assert salted.exceptAll(plain.select(*salted.columns)).count() == 0 and salted.count() == left.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_absent_from_two_keys(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, h1 string, h2 string")
    bank = spark.createDataFrame([("a", "q"), ("p", "y")], "h1 string, h2 string")
    got = joins.absent_from(df, (bank, ["h1"]), (bank, ["h2"]))
    assert [r["id"] for r in got.collect()] == [3]


@pytest.mark.parametrize("few", [10, 200_000])
def test_medians_of_a_hot_key(spark, monkeypatch, few):
    """One key has a third of all rows; its values are sorted in parts, and none is collected."""
    monkeypatch.setattr(ranking, "HOT_ROWS", few)
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", rng.choice([rng.gauss(0, 1), 1.5, 1.5])) for i in range(6000)] + [("none", None), (None, 4.0), (None, 7.0), ("one", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["m"] for r in ranking.medians(df, ["k"], "v", "m").collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got == pytest.approx(want) and got["none"] is None and got[None] == 5.5
    if few == 10:
        counts = ranking.value_counts(df, ["k"], "v", parts=6)
        assert {(r["k"], r["v"]): (r["_below"], r["_c"]) for r in counts.collect()} == {
            (k, v): (sum(1 for a, b in rows if a == k and (v is not None and (b is None or b < v))), sum(1 for r in rows if r == (k, v))) for k, v in set(rows)}
        sizes = [r[0] for r in counts.sparkSession.createDataFrame(rows, "k string, v double").where("k = 'hot'").distinct().repartitionByRange(6, "k", "v").groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 0.5 * sum(sizes)


def test_numbered_in_one_order(spark):
    rows = [(i * 7919 % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v int, id int")
    got = ranking.numbered(df, [F.col("v").desc(), F.col("id").asc()], "n").collect()
    assert [(r["v"], r["id"]) for r in sorted(got, key=lambda r: r["n"])] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r["n"] for r in got) == list(range(1, 3001))


def test_lag_equals_plain_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", t0 + dt.timedelta(minutes=rng.randrange(20000))) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, k string, at timestamp_ntz")
    got = ordered.lagged(df, ["k"], ["at", "id"], ["id"], 3)
    w = Window.partitionBy("k").orderBy("at", "id")
    want = df.select(F.col("id"), *[F.lag("id", n).over(w).alias(f"e{n}") for n in (1, 2, 3)])
    assert got.join(want, "id").where("NOT (id_lag1 <=> e1 AND id_lag2 <=> e2 AND id_lag3 <=> e3)").count() == 0


@pytest.mark.parametrize("window", [(None, None), ("1 day", "14 days")])
def test_nearest_equals_brute_force(spark, window):
    rng, t0 = random.Random(11), dt.datetime(2024, 1, 1)
    at = lambda: t0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 40))
    left = [(f"s{i}", rng.choice("ab"), at()) for i in range(150)]
    right = [(f"m{i}", rng.choice("abc"), at()) for i in range(120)]
    l = spark.createDataFrame(left, "sid string, k string, logged timestamp_ntz")
    r = spark.createDataFrame(right, "mid string, k string, sent timestamp_ntz")
    before, after = window
    got = {x["sid"]: x["match"]["id"] for x in matching.nearest_in_time(l, r, ["k"], "sid", "logged", "sent", "mid", before=before, after=after).collect()}
    for sid, k, t in left:
        c = [(abs(s - t), s, m) for m, kk, s in right if kk == k and (not before or -dt.timedelta(days=1) <= s - t <= dt.timedelta(days=14))]
        assert got.get(sid) == (min(c)[2] if c else None)


def test_fuzzy_loses_no_pair(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14))) for _ in range(80)]
    variants = []
    for w in words:
        i = rng.randrange(len(w))
        variants.append(w[:i] + rng.choice("abcd") + w[i + rng.randrange(2):])

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, prev = [i] + [0] * len(b), row
            for j, y in enumerate(b, 1):
                row[j] = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
        return row[-1]

    l = spark.createDataFrame([(w,) for w in set(variants)], "n string")
    r = spark.createDataFrame([(w,) for w in set(words)], "m string")
    got = {x["n"]: (x["m"], round(x["score"], 6)) for x in matching.best_similar(l, r, "n", "m").collect()}
    for v in set(variants):
        c = [(-(1 - distance(v, w) / max(len(v), len(w))), w) for w in set(words)]
        c = [x for x in c if -x[0] >= 0.8 - 1e-12]
        assert got.get(v) == ((min(c)[1], round(-min(c)[0], 6)) if c else None)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_segments_lose_no_pair(spark, edits):
    rng = random.Random(edits)
    right = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(120)]
    left = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(120)]
    l = spark.createDataFrame([(x, x) for x in set(left)], "_l string, _x string")
    r = spark.createDataFrame([(x, x) for x in set(right)], "_m string, _y string")
    every = l.join(r, F.levenshtein("_x", "_y") <= edits).select("_l", "_m")
    assert read_pairs(matching.segment_pairs(l, r, edits)) == read_pairs(every)


def read_pairs(df):
    return {tuple(r) for r in df.collect()}


def test_near_equal_names_meet_few_others(spark, monkeypatch):
    """20,000 names that differ in their last digits: pairs that meet, against all pairs."""
    names = spark.range(20_000).select(F.format_string("Customer#%09d", F.col("id") * 7).alias("m"))
    asked = spark.range(20_000).select(F.format_string("Customer#%09d", F.col("id") * 7 + 1).alias("n"))
    met, plain = [], matching.segment_candidates

    def counted(*args):
        met.append(plain(*args))
        return met[-1]

    monkeypatch.setattr(matching, "segment_candidates", counted)
    got = matching.best_similar(asked, names, "n", "m")
    assert got.count() == 20_000 and got.where("score < 1 - 1.0000001 / 18").count() == 0
    assert 0 < sum(df.count() for df in met) < 0.02 * 20_000**2
    assert matching.shared_ends(names, "m") == (12, 0)


def test_merge_keeps_the_fresher_row(spark):
    cols = "k string, v int, at int, id string"
    old = spark.createDataFrame([("a", 1, 10, "x"), ("b", 2, 10, "x")], cols)
    new = spark.createDataFrame([("a", 9, 10, "y"), ("b", 8, 11, "y"), ("c", 7, 1, "y")], cols)
    got = {r["k"]: r["v"] for r in upsert.merged(old, new, ["k"], "at", "id").collect()}
    assert got == {"a": 1, "b": 8, "c": 7}
    again = {r["k"]: r["v"] for r in upsert.merged(upsert.merged(old, new, ["k"], "at", "id"), new, ["k"], "at", "id").collect()}
    assert again == got
    assert {r["k"]: r["v"] for r in upsert.merged_any(old, new, ["k"]).collect()} == {"a": 9, "b": 8, "c": 7}
    assert [r["k"] for r in upsert.added_only(old, new, ["k"], [F.col("id")]).collect()] == ["c"]


def test_upsert_rewrites_only_touched_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    cols = "k string, v int, d date, at int, id string"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = spark.createDataFrame([("a", 1, d1, 1, "x"), ("b", 2, d2, 1, "x")], cols)
    second = spark.createDataFrame([("b", 5, d2, 2, "y"), ("c", 6, d2, 2, "y")], cols)
    upsert.upsert_partitions(spark, path, first, ["k"], "d", "at", "id")
    kept = sorted(p.name for p in (tmp_path / "t" / "d=2024-01-01").glob("*.parquet"))
    for _ in range(2):
        upsert.upsert_partitions(spark, path, second, ["k"], "d", "at", "id")
        got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
        assert got == {"a": 1, "b": 5, "c": 6}
    assert sorted(p.name for p in (tmp_path / "t" / "d=2024-01-01").glob("*.parquet")) == kept


def plan_days(spark, hours, low=8, high=22):
    rows = [("a", dt.date(2024, 1, 1), i, h, low, high) for i, h in enumerate(hours)]
    return spark.createDataFrame(rows, "account string, date_local date, slot_rank int, hod int, min_h int, max_h int")


@pytest.mark.parametrize("hours", [[9, 9, 9], [8, 22], [10, 11, 12, 13], [21, 22, 22], [8, 8, 8, 8, 8, 8, 8, 8]])
def test_spacing_rules(spark, hours):
    got = sorted(r["hod"] for r in slots.spaced_hours(plan_days(spark, hours)).collect())
    assert all(8 <= h <= 22 for h in got)
    assert all(b - a >= 2 for a, b in zip(got, got[1:])), got
    assert all(b - a <= 6 for a, b in zip(got, got[1:])), got


def test_gap_rules(spark):
    got = {(r["issue"], r["gap_h"]) for r in slots.gap_violations(plan_days(spark, [9, 10, 18])).collect()}
    assert got == {("MIN_GAP_LT_2H", 1), ("MAX_GAP_GT_6H_IN_WINDOW", 8)}


def test_feasibility(spark):
    plan = plan_days(spark, [9, 11], 10, 18).withColumn("dow", F.lit(0))
    policy = spark.createDataFrame([("a", 0, 6)], "account string, dow int, quota int")
    row = slots.feasibility_alerts(plan, policy).first()
    assert (row["window_width"], row["width_needed"]) == (8, 10)


def test_price_bump(spark):
    df = plan_days(spark, [9, 12, 15, 18]).withColumn("price", F.lit(10.2))
    got = sorted(r["price"] for r in slots.bumped(df, "price").collect())
    assert len({round(p) for p in got}) == 4


def test_diversity_conflicts_equal_pairs(spark):
    rng, t0 = random.Random(2), dt.datetime(2024, 1, 1)
    rows = [(f"p{a}", t0 + dt.timedelta(hours=h), f"t{rng.randrange(3)}", rng.random(), 1.0) for a in range(6) for h in range(24) if rng.random() < 0.5]
    pre = spark.createDataFrame(rows, "account_page string, slot_at timestamp_ntz, template string, preliminary double, rps_eb double")
    got = {(r["account_page"], r["slot_at"]): r["conflict"] for r in rank.diverse_ranking(pre).collect()}
    for a, t, tpl, _, _ in rows:
        want = any(b != a and u == tpl and abs((s - t).total_seconds()) <= 6 * 3600 for b, s, u, _, _ in rows)
        assert got[(a, t)] == want
