"""Sources, sinks and incremental runs on small files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from outpulse.plans import content, ingest, semantic
from outpulse.sources import driver_tables as src
from outpulse.sources import reports
from outpulse.sources.versions import Conflict, VersionedTable
from outpulse.streaming import jobs

from conftest import SF


@pytest.fixture(scope="module")
def landing(spark):
    return reports.landing_reports(spark, SF)


def split_json(landing, folder, parts):
    """Write the landing rows as ``parts`` batches of JSON files."""
    for i in range(parts):
        landing.where(F.pmod(F.xxhash64("message_id"), F.lit(parts)) == i).coalesce(1).write.mode("append").json(str(folder))


def read_set(df):
    return {tuple(str(v) for v in r) for r in df.collect()}


def test_landing_and_skip_of_seen_files(spark, landing, tmp_path):
    split_json(landing, tmp_path / "in", 2)
    out, ck = str(tmp_path / "land"), str(tmp_path / "ck")
    for _ in range(2):  # the second run finds nothing new
        jobs.land_stream(jobs.report_stream(spark, str(tmp_path / "in"), 1), out, ck)
        assert spark.read.parquet(out).count() == landing.count()


@pytest.mark.parametrize("per_batch", [1, 100])
def test_upsert_stream_equals_batch(spark, landing, tmp_path, per_batch):
    split_json(landing, tmp_path / "in", 3)
    out = str(tmp_path / "fact")
    jobs.upsert_stream(jobs.report_stream(spark, str(tmp_path / "in"), per_batch), out, str(tmp_path / "ck"), str(tmp_path / "bad"), "2024-01-03", "2024-12-31")
    want = ingest.normalised_reports(landing, "1900-01-01", "9999-12-31").where("sent_date >= '2024-01-03'")
    cols = ["send_key", "message_id", "price", "sent", "sent_date"]
    assert read_set(VersionedTable(spark, out, "sent_date").read().select(*cols)) == read_set(want.select(*cols))
    assert spark.read.parquet(str(tmp_path / "bad")).where("reason = 'send date out of range'").count() > 0


def test_daily_totals_and_first_seen(spark, landing, tmp_path):
    split_json(landing, tmp_path / "in", 1)
    out = str(tmp_path / "daily")
    jobs.daily_totals_stream(jobs.report_stream(spark, str(tmp_path / "in")), out, str(tmp_path / "ck"))
    got = jobs.daily_totals(spark, out)
    want = ingest.parsed_reports(landing).groupBy(F.to_date("sent_at").alias("day"), "sender").agg(F.count(F.lit(1)).alias("messages"))
    closed = got.select("day", "sender", "messages")
    assert closed.count() > 0 and closed.exceptAll(want).count() == 0  # days older than the horizon are final
    split_json(landing, tmp_path / "in", 1)  # every message again
    once = str(tmp_path / "once")
    jobs.first_seen_stream(jobs.report_stream(spark, str(tmp_path / "in")), once, str(tmp_path / "ck2"))
    ids = spark.read.parquet(once)
    assert ids.count() == ids.select("message_id").distinct().count() == landing.count()


def test_late_rows_count_in_their_day(spark, landing, tmp_path):
    """Newest files first, one per batch: closed days and waiting rows are all rows, and a second run merges what came later."""
    days = [r[0] for r in landing.select("ingestion_date").distinct().orderBy(F.desc("ingestion_date")).collect()]
    cuts = [days[0], days[len(days) // 4], days[len(days) // 2], days[-1]]
    folder, out, ck, once = (str(tmp_path / n) for n in ("in", "daily", "ck", "once"))
    rows = ingest.parsed_reports(landing)
    until = rows.agg(F.max("sent_at") - F.expr("INTERVAL 7 DAYS")).first()[0]
    want = rows.where(F.date_add(F.to_date("sent_at"), 1).cast("timestamp_ntz") <= F.lit(until)).groupBy(F.to_date("sent_at").alias("day"), "sender").agg(F.count(F.lit(1)).alias("messages"))
    for newest, oldest in zip(cuts, cuts[1:]):
        inside = landing.where((F.col("ingestion_date") <= newest) & ((F.col("ingestion_date") > oldest) | (F.lit(oldest == days[-1]) & (F.col("ingestion_date") == oldest))))
        inside.coalesce(1).write.mode("append").json(folder)
        jobs.daily_totals_stream(jobs.report_stream(spark, folder, 1), out, ck)
        jobs.first_seen_stream(jobs.report_stream(spark, folder, 1), once, f"{ck}2")
    assert read_set(jobs.daily_totals(spark, out).select("day", "sender", "messages")) == read_set(want)
    everything = jobs.daily_totals(spark, out, still_open=True)
    assert everything.agg(F.sum("messages")).first()[0] == rows.where("sent_at IS NOT NULL").count()
    assert everything.agg(F.sum("late_messages")).first()[0] > 0
    ids = spark.read.parquet(once)
    assert ids.count() == ids.select("message_id").distinct().count() == landing.count()


def test_daily_totals_touch_only_their_days(spark, landing, tmp_path):
    """Two triggers with late and unreadable rows between them; what a trigger does not hold stays in its folder."""
    folder, out, ck = (str(tmp_path / n) for n in ("in", "daily", "ck"))
    first = landing.where("ingestion_date BETWEEN '2024-01-10' AND '2024-01-25'")
    first.coalesce(1).write.mode("append").json(folder)
    jobs.daily_totals_stream(jobs.report_stream(spark, folder), out, ck)
    table, aside = jobs.daily_tables(spark, out)
    before = table.manifest()
    late = landing.where("ingestion_date BETWEEN '2024-01-03' AND '2024-01-04'")
    soon = landing.where("ingestion_date = '2024-01-26'").withColumn("sending_time", F.when(F.col("sender") == "S2", "soon").otherwise(F.col("sending_time")))
    late.unionByName(soon).coalesce(1).write.mode("append").json(folder)
    jobs.daily_totals_stream(jobs.report_stream(spark, folder), out, ck)
    after = table.manifest()
    touched = {d for d in after.parts if after.parts[d] != before.parts.get(d)}
    held = ingest.parsed_reports(late.unionByName(soon)).where("sent_at IS NOT NULL").select(F.to_date("sent_at").cast("string")).distinct()
    assert touched == {r[0] for r in held.collect()} and len(touched) < len(after.parts)
    kept = jobs.daily_totals(spark, out, still_open=True).agg(F.sum("messages"), F.sum("late_messages")).first()
    assert kept[0] + aside.read().count() == first.count() + late.count() + soon.count()
    assert kept[1] == late.count() and aside.read().count() == soon.where("sending_time = 'soon'").count() > 0
    assert read_set(table.read(at=before)) != read_set(table.read())  # the old version is still whole


def test_batch_that_runs_again_adds_nothing(spark, landing, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "ingestion_date")
    assert jobs._once(table, "ck", 0) == {"stream:ck": "0"}
    table.replace(landing.limit(3), marks=jobs._once(table, "ck", 0))
    assert jobs._once(table, "ck", 0) is None and jobs._once(table, "ck", 1) == {"stream:ck": "1"}


def test_killed_write_leaves_the_old_version(spark, landing, tmp_path, monkeypatch):
    """A write that stops before or after its files, or at the rename, is not seen; the next one goes through."""
    table = VersionedTable(spark, str(tmp_path / "t"), "ingestion_date")
    rows = landing.where("ingestion_date <= '2024-01-04'").select("message_id", "sender", "ingestion_date")
    table.overwrite(rows)
    old, change = read_set(table.read()), rows.where("ingestion_date = '2024-01-03'").withColumn("sender", F.lit("new"))

    class Killed(Exception):
        pass

    def stop(*_):
        raise Killed

    for step in ("stage", "publish"):
        with monkeypatch.context() as m:
            m.setattr(VersionedTable, step, stop)
            with pytest.raises(Killed):
                table.replace(change)
        assert read_set(table.read()) == old
    with pytest.raises(Exception):  # half of the files are there when a task fails
        table.replace(change.withColumn("sender", F.when(F.col("message_id") < "m5", "new").otherwise(F.raise_error(F.lit("lost")).cast("string"))))
    assert read_set(table.read()) == old
    stale = table.manifest()
    table.replace(change)
    assert table.read(["2024-01-03"]).select("sender").distinct().first()[0] == "new" and table.read().count() == rows.count()
    with pytest.raises(Conflict):
        table.replace(change, at=stale)
    with pytest.raises(Exception, match="is null"):
        table.replace(change.withColumn("ingestion_date", F.lit(None).cast("date")))
    found = table.read().count()
    assert table.expire() >= 1 and table.read().count() == found


def test_two_writers_both_count(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "d")
    row = lambda n: spark.createDataFrame([("a", n)], "d string, n int")
    other = []

    def merge(old, new):
        if not other:  # another writer commits while this one merges
            other.append(table.change(row(100), lambda o, r: r if o is None else o.unionByName(r)))
        return new if old is None else old.unionByName(new)

    table.change(row(1), merge)
    assert sorted(r.n for r in table.read().collect()) == [1, 100]


def test_first_seen_cost_follows_the_batch(spark, tmp_path):
    """Later batches put only their new ids into the state, and the session keeps its own settings."""
    folder, out, ck = (str(tmp_path / n) for n in ("in", "once", "ck"))
    known = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    schema = jobs.LANDING_SCHEMA
    rows = lambda a, b: spark.range(a, b).select(*[(F.concat(F.lit("m"), "id") if f.name == "message_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    hot = rows(0, 1).crossJoin(spark.range(3000).select())
    added = []
    for part in (rows(0, 5000).unionByName(hot), rows(4990, 5010).unionByName(hot), hot):
        part.write.mode("append").json(folder)
        query = jobs.first_seen_stream(jobs.report_stream(spark, folder), out, ck)
        added.append(sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["stateOperators"]))
    assert added == [5000, 10, 0]
    assert spark.read.parquet(out).count() == 5010 and spark.conf.get("spark.sql.streaming.stateStore.providerClass") == known


def test_refresh_if_stale(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    ran = []
    assert jobs.refresh_if_stale(df, "t", "2024-01-03 00:00:00", 24, lambda: ran.append(1)) and ran == [1]
    assert not jobs.refresh_if_stale(df, "t", "2024-01-01 05:00:00", 24, lambda: ran.append(1)) and ran == [1]


def test_csv_headers_encoding_and_standard_columns(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_bytes("Caption,Sent At,Price,Price,Views\nhi,2024-01-01,$5,6,\"1,200\"\n,,,,\n".encode())
    (d / "b.csv").write_bytes("Caption,Sent At,Price,Price,Views\ncaf\xe9,2024-01-02,7,8,3\n".encode("latin-1"))
    assert reports.unique_headers(["Price ", "price", "Sent-At!"]) == ["price", "price_2", "sent_at"]
    df = reports.read_text_with_fallback(spark, str(d))
    assert {r["caption"] for r in df.collect()} == {"hi", "café"}
    std = reports.standardise(df.drop("source_file"))
    row = std.where("message = 'hi'").first()
    assert (row["sending_time"], row["price"], row["viewed"], row["sent"]) == ("2024-01-01", "$5", 1200, None)
    assert "price_2" in std.columns
    assert "missing source_file" in reports.missing_required(std).first()["reasons"]


def test_files_of_other_headers_and_encodings(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_bytes(b"\xef\xbb\xbf" + "Caption,Views\r\n\r\nna\u00efve,1\r\nCaption,Views\r\nb\r\n".encode())
    (d / "b.csv").write_bytes("Views,Note,Note,Caption\n2,x,\"y,z\",caf\xe9\n,,,\n".encode("latin-1"))
    (d / "c.csv").write_bytes(b"Caption,Views\n")
    (d / "d.csv").write_bytes(b"")
    lines = "".join(f"r{i},{i}\n" for i in range(3000))
    (d / "e.csv").write_bytes(("Caption,Views\n" + lines + "last \xfc,7\n").encode("latin-1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # e.csv is several tasks; only the last line is not ASCII
    try:
        df = reports.read_text_with_fallback(spark, str(d))
        assert set(df.columns) == {"source_file", "row_id", "caption", "views", "note", "note_2"}
        got = {(r.caption, r.views, r.note, r.note_2) for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {("na\u00efve", "1", None, None), ("b", None, None, None), ("caf\xe9", "2", "x", "y,z"), ("last \xfc", "7", None, None)} | {(f"r{i}", str(i), None, None) for i in range(3000)}


def test_sinks(spark, landing, tmp_path):
    path = str(tmp_path / "land")
    reports.land(landing, path)
    assert spark.read.parquet(path).count() == landing.count()
    with pytest.raises(ValueError):
        reports.land(landing.drop("run_id"), path)
    table = str(tmp_path / "t")
    small = landing.select("message_id", "sender", "ingestion_date").where("ingestion_date <= '2024-01-05'")
    reports.write_table(small, table, "ingestion_date", ["sender"])
    reports.replace_partitions(small.where("ingestion_date = '2024-01-05'").limit(1), table, "ingestion_date")
    got = spark.read.parquet(table)
    assert got.where("ingestion_date = '2024-01-05'").count() == 1 and got.where("ingestion_date < '2024-01-05'").count() > 0
    week = str(tmp_path / "w")
    reports.append_week(small, week, "2024-01-10")
    assert str(spark.read.parquet(week).first()["week_start"]) == "2024-01-08"
    counts = reports.export_by_category(small.select("message_id", "sender"), str(tmp_path / "c"), "sender")
    assert counts.agg(F.sum("count")).first()[0] == small.count()


def test_quarantine_splits_every_row_once(spark, landing):
    broken = landing.withColumn("sending_time", F.when(F.col("sender") == "S1", "soon").otherwise(F.col("sending_time")))
    good, bad = content.quarantine(broken, 2018, 2024)
    assert good.count() + bad.count() == landing.count()
    assert bad.count() == landing.where("sender = 'S1'").count()
    assert '"sending_time":"soon"' in bad.first()["raw_data"]


def test_bank_update_logs_success_and_failure(spark, tmp_path):
    docs = src.templates(spark, SF).selectExpr("doc_id AS source_id", "body", "1 AS priority")
    empty = spark.createDataFrame([], "hash_v1 string, hash_v2 string")
    inflow = content.template_inflow(docs, empty)
    log = str(tmp_path / "log")
    done = content.update_bank(spark, inflow, str(tmp_path / "bank"), log, "r1", "2024-01-31")
    assert done["inserted"] == done["source_rows"] == spark.read.parquet(str(tmp_path / "bank")).count()
    bank = spark.read.parquet(str(tmp_path / "bank")).select("hash_v1", "hash_v2")
    assert content.template_inflow(docs, bank).count() == 0
    with pytest.raises(Exception):
        content.update_bank(spark, inflow.drop("body"), str(tmp_path / "bank"), log, "r2", "2024-01-31")
    assert sorted((r["run_id"], r["errors"]) for r in spark.read.parquet(log).collect()) == [("r1", 0), ("r2", 1)]
    day = content.ingestion_monitor(spark.read.parquet(log)).first()
    assert (str(day["run_date"]), day["runs"], day["inserted"], day["errors"]) == ("2024-01-31", 2, done["inserted"], 1)


def test_settings_and_json_configuration(spark):
    s = spark.createDataFrame([("nu", "150"), ("x", "1")], "setting_key string, setting_val string")
    assert content.settings_row(s, {"nu": "200", "w": "0.1"}).first().asDict() == {"nu": 150.0, "w": 0.1}
    doc = '{"weights":{"performance":0.4,"exploration":0.2,"recency":0.2,"stability":0.2},"exploration":{"epsilon_percent":10,"ucb_c":2.0},"cooldown":{"min_hours":6,"fatigue_threshold":0.8}}'
    rows = [("a", "prod", "active", doc, True, None), ("b", "prod", "new", doc, True, dt.datetime(2023, 1, 1)), ("c", "dev", "new", doc, True, None), ("d", "prod", "new", doc, False, None)]
    p = spark.createDataFrame(rows, "config_id string, environment string, page_state string, parameters string, is_active boolean, expires_at timestamp_ntz")
    got = content.active_configuration(p, "2024-01-31 00:00:00").collect()
    assert [(r["config_id"], r["w_performance"], r["ucb_c"], r["min_cooldown_hours"]) for r in got] == [("a", 0.4, 2.0, 6.0)]


def test_stored_tier_thresholds_win(spark):
    scored = spark.createDataFrame([("a", 1.0, 500.0, 10.0, 10.0), ("b", -1.0, 5.0, 0.0, 0.0)], "account string, intensity double, active_fans double, message_net double, earnings double")
    low = semantic.tier_thresholds(scored).select("population", *[F.lit(-9.0).alias(c) for c in ("q40", "q60", "q90", "fans_p70", "net_p60", "net_p70", "earn_p70")])
    own = {r["account"]: r["tier"] for r in semantic.tier_assignment(scored, low.limit(0)).collect()}
    stored = {r["account"]: r["tier"] for r in semantic.tier_assignment(scored, low).collect()}
    assert own == {r["account"]: r["tier"] for r in semantic.tier_assignment(scored).collect()}
    assert stored == {"a": "POWER", "b": "LOW"}


def test_same_result_after_reorder_and_repartition(spark):
    f, a, t = src.send_facts(spark, SF), src.accounts(spark, SF), src.templates(spark, SF)
    cols = ["metric_date", "template", "account", "sends", "pct_in_account", "performance_tier"]
    one = semantic.daily_performance(f, a, t, src.EVENTS_AS_OF).select(*cols)
    two = semantic.daily_performance(f.orderBy(F.desc("message_id")).repartition(7), a.repartition(3), t, src.EVENTS_AS_OF).select(*cols)
    assert read_set(one) == read_set(two)
