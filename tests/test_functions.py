"""Column functions on hand-computed cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from outpulse.functions import clock, hashing, money, text
from outpulse.functions import numeric as n


def one(spark, expr, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*cols).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("sent,bought,want", [(10, 2, 0.125), (1000, 150, 153 / 1030)])
def test_shrink(spark, sent, bought, want):
    assert one(spark, n.shrink("b", "s", F.lit(0.1), 30), b=bought, s=sent) == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("trials,want", [(10, 1.175394), (100, 0.371692), (1000, 0.117539)])
def test_ucb(spark, trials, want):
    assert one(spark, n.ucb_bonus(F.lit(1000), "t", 1.0), t=trials) == pytest.approx(want, abs=1e-5)


def test_nulls_and_zero(spark):
    assert one(spark, n.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, n.strict_least(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, n.strict_greatest(F.lit(1), F.lit(3))) == 3
    assert one(spark, n.whole(F.lit(2.7))) == 3


def test_decay_and_cooldown(spark):
    assert one(spark, n.half_life(F.lit(45), 45)) == pytest.approx(0.5)
    assert one(spark, n.power_decay(F.lit(2))) == pytest.approx(0.9025)
    got = one(spark, n.cooldown_end(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"), F.lit(2), F.lit(6.0)))
    assert got == dt.datetime(2024, 1, 1, 13, 30)


@pytest.mark.parametrize("raw,want", [("$1,234.50", 1234.5), ("(5.00)", -5.0), ("N/A", 0), ("", 0), (None, 0)])
def test_money(spark, raw, want):
    assert float(one(spark, money.parse_money(F.lit(raw).cast("string")))) == want


@pytest.mark.parametrize("raw,want", [("1,200", 1200), ("x", 0), ("2.6", 3)])
def test_count(spark, raw, want):
    assert one(spark, money.parse_count(F.lit(raw))) == want


@pytest.mark.parametrize(
    "raw", ["Aug 22, 2025 at 11:07 PM", "2025-08-22 23:07:00", "2025-08-22T23:07:00", "08/22/2025 23:07"]
)
def test_report_time(spark, raw):
    assert one(spark, clock.parse_report_time(F.lit(raw))) == dt.datetime(2025, 8, 22, 23, 7)


def test_report_time_unreadable(spark):
    assert one(spark, clock.parse_report_time(F.lit("soon"))) is None


def test_weekdays_and_weeks(spark):
    sunday = F.lit(dt.date(2024, 1, 7))
    assert one(spark, clock.monday_based(sunday)) == 6
    assert one(spark, clock.sunday_based(sunday)) == 1
    assert one(spark, clock.sunday_week(sunday)) == 1
    assert one(spark, clock.sunday_week(F.lit(dt.date(2024, 1, 6)))) == 0


def test_zone_round_trip(spark):
    at = F.lit(dt.datetime(2024, 7, 1, 12)).cast("timestamp_ntz")
    assert one(spark, clock.local(at, "America/New_York")) == dt.datetime(2024, 7, 1, 8)
    assert one(spark, clock.to_utc(clock.local(at, "Asia/Tokyo"), "Asia/Tokyo")) == dt.datetime(2024, 7, 1, 12)


@pytest.mark.parametrize("raw,want", [("Tessa Thomas VIP.xlsx", "tessa thomas vip"), ("a/b/Diana_Grace_2024-01-05.xlsx", "diana grace")])
def test_file_account(spark, raw, want):
    assert one(spark, text.file_account(F.lit(raw))) == want


@pytest.mark.parametrize("raw,want", [("Tessa Thomas VIP", "tessa thomas"), ("Diana Grace - Paid", "diana grace"), ("Solo", "solo")])
def test_strip_kind(spark, raw, want):
    assert one(spark, text.strip_kind(F.lit(raw))) == want


def test_account_kind(spark):
    assert [one(spark, text.account_kind(F.lit(x))) for x in ("Ann VIP", "Ann free", "Ann (paid)", "Ann")] == ["vip", "free", "paid", "main"]


def test_empty_texts_share_a_hash(spark):
    got = {one(spark, text.sentinel_hash(F.lit(x).cast("string"))) for x in (None, "n/a", "-", "  ")}
    assert len(got) == 1
    assert one(spark, text.sentinel_hash(F.lit("hello"))) not in got


def test_canonical_text(spark):
    assert one(spark, text.canonical_text(F.lit("  Ｈello​ \n World "))) == "hello world"
    assert one(spark, text.canonical_text(F.lit("ﬁne"))) == "fine"


def test_text_features(spark):
    assert one(spark, text.length_bin(F.lit("a b c"))) == "short"
    assert one(spark, text.emoji_count(F.lit("hi 😀🚀"))) == 2
    assert one(spark, text.has_cta(F.lit("please sign up, now"))) is True
    assert one(spark, text.has_cta(F.lit("clicking"))) is False
    assert one(spark, text.has_urgency(F.lit("wow!!"))) is True
    assert one(spark, text.ends_with_question(F.lit("ready? "))) is True
    assert one(spark, text.content_level(F.lit("hello"))) == "mild"
    assert one(spark, text.content_level(F.lit("hello, unlock this"))) == "moderate"
    assert one(spark, text.theme_tags(F.lit("hello, birthday sale today?"))) == "birthday,greeting,promotional,question,urgent"
    assert one(spark, text.theme_tags(F.lit(" "))) == "untagged"


def test_html_and_clean(spark):
    assert one(spark, text.strip_html(F.lit("<p>a<script>x()</script>&nbsp;b</p>"))) == "a b"
    assert one(spark, text.clean_text(F.lit("N/A"))) is None


def test_hashes_are_stable_and_uniform(spark):
    rows = spark.range(20000).select(hashing.hash_uniform("id", F.lit("k")).alias("u"), hashing.jitter(-10, 10, "id").alias("j"))
    a = rows.agg(F.avg("u").alias("m"), F.min("u").alias("lo"), F.max("u").alias("hi"), F.min("j").alias("jl"), F.max("j").alias("jh")).first()
    assert abs(a["m"] - 0.5) < 0.01 and 0 <= a["lo"] and a["hi"] < 1 and (a["jl"], a["jh"]) == (-10, 10)
    assert one(spark, hashing.hash_int(F.lit("a"))) == one(spark, hashing.hash_int(F.lit("a")))


def test_row_key(spark):
    f = lambda mid: one(spark, hashing.report_row_key("m", "f", "t", "b"), m=mid, f="x.csv", t="now", b="hi")
    assert f("id1") == "id1"
    assert len(f(" ")) == 64
