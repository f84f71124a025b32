"""Nothing is lost: hot groups, rejected rows, repeated runs, compatibility characters."""

import bisect
import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from outpulse.functions import text
from outpulse.operators.matching import nearest_in_time
from outpulse.operators.ordered import lagged, sliced
from outpulse.plans import content, slots
from outpulse.sources import reports

from conftest import SF


def test_nearest_in_one_hot_day(spark):
    """One key, one day: time must not grow with the square of the rows."""

    def side(n, name, seed):
        at = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(secs=F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(86_400_000)).cast("decimal(18,6)") / 1000)
        return spark.range(n).select(F.lit("a").alias("k"), F.col("id").alias(name), at.alias(f"{name}_at"))

    took = {}
    for n in (3000, 30_000, 60_000):
        start = time.time()
        got = nearest_in_time(side(n, "l", 1), side(n, "r", 2), ["k"], "l", "l_at", "r_at", "r").select("l", "match.id")
        assert got.count() == n
        took[n] = time.time() - start
    assert took[60_000] < 4 * max(took[30_000], 1)
    found = {r.l: r.id for r in nearest_in_time(side(3000, "l", 1), side(3000, "r", 2), ["k"], "l", "l_at", "r_at", "r").select("l", "match.id").collect()}
    left = {r.l: r.l_at.timestamp() for r in side(3000, "l", 1).collect()}
    right = {r.r: r.r_at.timestamp() for r in side(3000, "r", 2).collect()}
    times = np.array(sorted(right.values()))
    for i, at in left.items():
        assert abs(right[found[i]] - at) == pytest.approx(np.abs(times - at).min(), abs=1e-6)


def test_canonical_text_folds_compatibility_characters(spark):
    many = ["ﬁne ﬂow", "ＦＵＬＬ　width", "plain text", "①②", "a​b", "ǆ", None]
    df = spark.createDataFrame([(t,) for t in many], "t string")
    got = [r[0] for r in df.select(text.canonical_text("t")).collect()]
    want = [" ".join(unicodedata.normalize("NFKC", (t or "").strip().lower()).replace("​", "").split()) for t in many]
    assert got == want


def test_landing_sets_bad_rows_aside(spark, tmp_path):
    rows = reports.landing_reports(spark, SF).withColumn("message_id", F.when(F.col("sent") % 3 != 0, F.col("message_id")))
    with pytest.raises(ValueError):
        reports.land(rows, str(tmp_path / "none"))
    reports.land(rows, str(tmp_path / "rows"), str(tmp_path / "bad"))
    kept, bad = spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "bad"))
    assert bad.count() > 0 and kept.count() + bad.count() == rows.count()
    assert {tuple(r.reasons) for r in bad.collect()} == {("missing message_id",)}


def test_refused_and_taken_templates_are_everything(spark):
    rows = spark.createDataFrame([(1, "hi"), (2, "a fine text"), (3, None), (4, "x" * 5000), (5, "bad � text")], "source_id int, body string").withColumn("priority", F.lit(1))
    bank = spark.createDataFrame([], "hash_v1 string, hash_v2 string")
    taken = {r.source_id for r in content.template_inflow(rows, bank).collect()}
    refused = {r.source_id: r.reason for r in content.refused_templates(rows).collect()}
    assert taken == {2, 4} and refused == {1: "too short", 3: "no text", 5: "damaged text"}
    assert {r.source_id for r in content.refused_templates(rows, max_chars=2000).collect()} == {1, 3, 4, 5}


def test_a_repeated_run_adds_nothing_to_the_bank(spark, tmp_path):
    rows = spark.createDataFrame([(1, "one text"), (2, "two texts")], "source_id int, body string").withColumn("priority", F.lit(1))
    inflow = content.template_inflow(rows, spark.createDataFrame([], "hash_v1 string, hash_v2 string"))
    bank, log = str(tmp_path / "bank"), str(tmp_path / "log")
    assert content.update_bank(spark, inflow, bank, log, "r1", "2024-01-31")["inserted"] == 2
    assert content.update_bank(spark, inflow, bank, log, "r1", "2024-01-31")["inserted"] == 0
    assert spark.read.parquet(bank).count() == 2


def test_price_steps_by_position():
    assert slots.LADDER == (-1.0, 0.0, 1.0, 2.0, -2.0)


def hot_day(spark, rows):
    """A third of all rows in one account and day, a tenth at one moment of it; the rest over 30 days and 50 accounts."""
    n = F.col("id")
    at = F.when(n % 10 == 0, 43_200).when(n % 3 == 0, F.pmod(F.xxhash64("id"), F.lit(86_400))).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30 * 86_400)))
    key = F.when((n % 10 == 0) | (n % 3 == 0), "hot").when(n % 41 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("a"), n % 50))
    return spark.range(rows).select("id", key.alias("k"), (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(secs=at.cast("decimal(18,6)"))).alias("at"))


def test_slices_follow_the_density(spark):
    parts, rows = 24, 48_000
    found = sliced(hot_day(spark, rows), ["k"], ["at", "id"], parts)
    sizes = [r["count"] for r in found.groupBy("k", "_c").count().collect()]
    assert sum(sizes) == rows and max(sizes) < 2 * rows / parts
    hot = found.where("k = 'hot' AND to_date(at) = date'2024-01-01'").groupBy("_c").count().count()
    assert hot >= parts / 4  # one account and day is several sorts


def test_lag_and_nearest_of_a_hot_day(spark):
    df = hot_day(spark, 20_000).cache()
    got = lagged(df, ["k"], ["at", "id"], ["id"], 3, parts=16)
    w = Window.partitionBy("k").orderBy("at", "id")
    want = df.select(F.col("id"), *[F.lag("id", n).over(w).alias(f"e{n}") for n in (1, 2, 3)])
    assert got.count() == 20_000
    assert got.join(want, "id").where("NOT (id_lag1 <=> e1 AND id_lag2 <=> e2 AND id_lag3 <=> e3)").count() == 0

    left, right = df.where("id % 2 = 0").toDF("l", "k", "l_at"), df.where("id % 2 = 1").toDF("r", "k", "r_at")
    found = {r.l: (r.id, r.gap) for r in nearest_in_time(left, right, ["k"], "l", "l_at", "r_at", "r", parts=16).selectExpr("l", "match.id", "match.at AS gap").collect()}
    moments = {}
    for r in right.where("k IS NOT NULL").collect():
        moments.setdefault(r.k, {}).setdefault(r.r_at, []).append(r.r)
    whole = {k: sorted(v) for k, v in moments.items()}
    for r in left.where("k IS NOT NULL").collect():
        if r.k not in whole:
            assert r.l not in found
            continue
        times = whole[r.k]
        i = bisect.bisect_left(times, r.l_at)
        best = min(times[max(0, i - 1) : i + 1], key=lambda t: (abs(t - r.l_at), t))
        assert found[r.l] == (min(moments[r.k][best]), best)
