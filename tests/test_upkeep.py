"""Interval sweeps, typed bulk load, settings over time: against plain Python on small rows."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.catalog import planning
from outpulse.functions import text
from outpulse.operators.intervals import overlap_report
from outpulse.plans import content, quality, rank, settings, slots
from outpulse.sources import bulk

from conftest import SF


def test_overlap_equals_day_sets(spark):
    rng, first = random.Random(4), dt.date(2024, 1, 1)
    side = lambda n: [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), rng.randrange(8), first + dt.timedelta(days=rng.randrange(60)), rng.randrange(9)) for _ in range(n)]
    one, other = side(120) + [("only", 1, first, 5)], side(40) + [("late", 1, None, 5)]
    schema = "k string, load int, day date, value int"
    got = {r.k: r for r in overlap_report(spark.createDataFrame(one, schema), spark.createDataFrame(other, schema), ["k"], ("load", "load"), "day", "value").collect()}

    def days(rows, k):
        spans = {}
        for key, load, day, _ in rows:
            if key == k and day:
                spans.setdefault(load, []).append(day)
        return {min(v) + dt.timedelta(days=i) for v in spans.values() for i in range((max(v) - min(v)).days + 1)}

    assert set(got) == {"hot", "a", "b", None, "only"}
    for k, r in got.items():
        both = days(one, k) & days(other, k)
        inside = lambda rows: [v for key, _, day, v in rows if key == k and day in both]
        assert (r.overlap_days, r.one_rows_in, r.one_value_in) == (len(both), len(inside(one)), sum(inside(one)))
        assert (r.other_rows_in, r.other_value_in) == (len(inside(other)), sum(inside(other)))
        assert r.one_rows == sum(key == k for key, *_ in one)


def test_bulk_load_keeps_every_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,n,ok,at\nx1,"1,200",yes,2024-01-02\nx2,many,no,2024-01-02\nx3,5\nx4,6,t,2024-01-02,extra\n,7,1,2024-13-02\n"x ""5""",8,,\n')
    (tmp_path / "b.csv").write_text('id,n,ok,at\nx6,9,Y,2024-02-30\n')
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("ok", T.BooleanType()), T.StructField("at", T.DateType())])
    rows = bulk.bulk_load(spark, str(tmp_path), schema, ("id",)).collect()
    assert len(rows) == 7
    good = {r.id: (r.n, r.ok, r["at"]) for r in rows if r.reasons is None}
    assert good == {"x1": (1200, True, dt.date(2024, 1, 2)), "x3": (5, None, None), 'x "5"': (8, None, None)}
    assert all(r.raw is None for r in rows if r.reasons is None)
    bad = sorted((r.reasons, json.loads(r.raw).get("n")) for r in rows if r.reasons is not None)
    assert bad == [(["at is not date"], "9"), (["at is not date", "id is missing"], "7"), (["n is not bigint"], "many"), (["surplus values"], "6")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "c.csv").write_text("id,n,ok,at\n")
    assert bulk.bulk_load(spark, str(tmp_path / "none"), schema).count() == 0


@pytest.mark.parametrize(("raw", "want"), [("true", True), (" T ", True), ("1", True), ("Yes", True), ("y", True), ("no", False), ("0", False), ("", False), ("maybe", False), (None, None)])
def test_truthy(spark, raw, want):
    assert spark.range(1).select(text.truthy(F.lit(raw).cast("string"))).first()[0] is want


def test_seeds(spark):
    made = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    table, seed = made(("a", 1), ("b", 2)), made(("b", 9), ("c", 3))
    assert sorted(map(tuple, settings.seeded(table, seed, ["k"]).collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted(map(tuple, settings.seeded(table, seed, ["k"], update=True).collect())) == [("a", 1), ("b", 9), ("c", 3)]


def test_settings_at_a_time(spark):
    rng, t0 = random.Random(8), dt.datetime(2024, 1, 1)
    history = [(rng.choice("ab"), i, t0 + dt.timedelta(hours=rng.randrange(20 * 24)), float(i)) for i in range(25)] + [("a", 90, t0 + dt.timedelta(days=3), 90.0), ("a", 91, t0 + dt.timedelta(days=3), 91.0), ("a", 92, None, 0.0)]
    live = settings.versions(spark.createDataFrame(history, "k string, version int, since timestamp_ntz, w double"), ["k"], "since")
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), t0 + dt.timedelta(minutes=rng.randrange(-1440, 25 * 1440))) for i in range(400)]
    got = settings.at_time(spark.createDataFrame(rows, "id int, k string, at timestamp_ntz"), live, ["k"], "at", ["w"], {"w": F.lit(-1.0)}, "2024-02-01")
    found = {r.id: (r.w, r.matched) for r in got.collect()}
    assert len(found) == len(rows)
    for i, k, at in rows:
        past = [(since, version, w) for key, version, since, w in history if key == k and since and since <= at]
        assert found[i] == ((max(past)[2], True) if past else (-1.0, False))


def test_cooldowns_know_the_level_of_copy_never_sent(spark):
    named = planning.ranked_copy(spark, SF).select("template")
    ranked = planning.diverse(spark, SF).select("template").distinct()
    assert named.count() == ranked.join(named, "template").count() > 0
    # Two templates on one account, neither sent before: the one with a level rests by it.
    slots = spark.createDataFrame([("p", t, dt.datetime(2024, 2, 1), 0.0, 0.1) for t in ("t1", "t2")], "account_page string, template string, slot_at timestamp_ntz, rps_eb double, score double")
    copy = spark.createDataFrame([("t1", "an explicit note for adults"), ("t2", "a plain note")], "template string, body string").withColumn("category", F.lit("x"))
    none = lambda schema: spark.createDataFrame([], schema)
    page = spark.createDataFrame([("acct", "p")], "account string, account_page string")
    got = rank.smart_cooldowns(
        slots, copy.select("template", text.content_level("body").alias("content_level")), none("account string, template string, fatigue double"),
        none("account string, template string, last_used_at timestamp_ntz"), none("template string, engagement double"), none("account string, volume_tier string"), page, "2024-01-31 00:00:00")
    assert {r.template: r.base_days for r in got.collect()} == {"t1": 10, "t2": 5}


def test_table_health(spark):
    rows = [("a", "2024-01-30"), ("b", "2024-01-29"), ("b", "2024-01-28"), (None, "2024-01-31"), (None, None)]
    df = spark.createDataFrame(rows, "k string, d string").withColumn("d", F.to_date("d"))
    def of(x, day="d"):
        r = quality.table_health("t", x, ["k"], F.col(day) if day else None, "2024-01-31 00:00:00").first()
        return r.records, r.missing_keys, r.repeated_keys, str(r.latest), r.status

    assert of(df) == (5, 2, 1, "2024-01-31", "KEY ISSUES")
    assert of(df.where("k = 'a'")) == (1, 0, 0, "2024-01-30", "HEALTHY")
    assert of(df.where("k = 'a'"), None) == (1, 0, 0, "None", "HEALTHY")
    assert of(df.where("d < DATE'2024-01-29'")) == (1, 0, 0, "2024-01-28", "STALE")
    assert of(df.where("false")) == (0, 0, 0, "None", "EMPTY")
    parts = [quality.table_health("t", x, ["k"], F.col("d"), "2024-01-31 00:00:00") for x in (df.where("k = 'a'"), df.where("false"))]
    assert {r.dataset: r.status for r in quality.with_overall(parts).collect()}["all"] == "ISSUES DETECTED"
    assert {r.dataset: r.status for r in quality.with_overall(parts[:1]).collect()}["all"] == "HEALTHY"


def test_override_outcomes(spark):
    made = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("day", F.to_date("day"))
    o = made([(f"o{i}", "S", "a", "n", "p", "2024-01-20" if i else "2023-11-01") for i in range(7)], "override_id string, assignee string, account string, new_template string, old_template string, day string")
    f = spark.createDataFrame([("o0", "S", "a", "SUCCESS", 50.0)] + [(f"o{i}", "S", "a", "FAILURE", -11.0 if i < 3 else -1.0) for i in range(1, 6)], "override_id string, assignee string, account string, result string, delta double")
    sends = spark.createDataFrame([("a", "n", "2024-01-20", 10, 5), ("a", "n", "2024-01-21", 10, 0), ("a", "p", "2024-01-02", 8, 2)], "account string, template string, sent_date string, sent long, viewed long").withColumn("sent_date", F.to_date("sent_date"))
    got = {r.override_id: r for r in content.override_training(o, f, content.open_rate_changes(o, sends), "2024-01-31 00:00:00").collect()}
    assert set(got) == {f"o{i}" for i in range(1, 7)}  # the old one counts for its assignee only
    assert (got["o1"].total_overrides, got["o1"].successful, got["o1"].open_rate_delta) == (7, 1, 0.25)
    assert [got[f"o{i}"].training_priority for i in (1, 3, 6)] == ["HIGH_COST_MISTAKE", "STANDARD_SIGNAL", "STANDARD_SIGNAL"] and got["o6"].result is None
    best = content.override_impacts(f).first()
    assert [x.delta for x in best.impacts] == [50.0, -11.0, -11.0, -1.0, -1.0] and best.overrides == 6


def test_export_blocks_levels_by_page_type_and_falls_back(spark):
    pages = ["main", "vip", "free", "other"]
    ranked = spark.createDataFrame([("a", f"a__{p}", p, i, 10, 0, "t", 1, True, True, "r", 50.0, "c", False, 1) for i, p in enumerate(pages)],
        "account string, account_page string, page_type string, day int, hod int, slot_rank int, template string, rank int, cooldown_ok boolean, dedupe_ok boolean, reason string, score_100 double, category string, cold_start boolean, days_since_used int")
    ranked = ranked.withColumn("date_local", F.date_add(F.to_date(F.lit("2024-01-31")), F.col("day")))
    accounts = spark.createDataFrame([("a", "low", "S")], "account string, tier string, assignee string")
    def templates_of(level):
        rows = slots.schedule_export(ranked, spark.createDataFrame([("t", "some copy", level)], "template string, body string, level string"), accounts, ("bad",), blocked_levels=(("main", "high"),))
        return {r.page_type: (r.template, r.reason) for r in rows.where("ladder_position = 3").collect()}

    assert templates_of("low") == dict.fromkeys(pages, ("t", "r"))
    assert templates_of("high") == dict.fromkeys(pages, ("t", "r")) | {"main": ("FALLBACK_001", "compliance_filtered")}
    blocked = slots.schedule_export(ranked, spark.createDataFrame([("t", "so BAD")], "template string, body string"), accounts, ("bad",))
    found = {r.page_type: (r.template, float(r.price)) for r in blocked.where("ladder_position = 3").collect()}
    assert found == {"main": ("FALLBACK_001", 15.5), "vip": ("FALLBACK_002", 21.0), "free": ("FALLBACK_003", 20.99), "other": (None, 20.99)}
