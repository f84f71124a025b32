"""Loads, run logs, overlap reports and settings: the upkeep of the tables the other areas read."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.catalog import ingest as ing
from outpulse.catalog import quality as qa
from outpulse.catalog import semantic as sem
from outpulse.catalog.base_sql import sql_strip_html
from outpulse.catalog.jobs import place
from outpulse.catalog.registry import SHARED_SQL, product
from outpulse.functions import hashing, text
from outpulse.operators.intervals import overlap_report
from outpulse.plans import content, settings
from outpulse.sources import bulk
from outpulse.sources import driver_tables as src
from outpulse.sources.reports import landing_reports


@product(
    "backfill_overlap",
    "account history_rows:i live_rows:i overlap_days:i history_rows_in:i live_rows_in:i history_revenue_in:r live_revenue_in:r",
    """WITH h AS (SELECT coalesce(standard_name, lower(s.raw_name)) AS account, s.revenue, CAST(sent_at AS DATE) AS day FROM c_split s LEFT JOIN c_names n ON lower(n.raw_name) = lower(s.raw_name)
         WHERE s.revenue >= 0 AND coalesce(standard_name, lower(s.raw_name)) IN (SELECT account FROM c_accounts WHERE is_active)),
       hd AS (SELECT DISTINCT account, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT account, min(day) AS a, max(day) AS z FROM h GROUP BY account, date_trunc('week', day))),
       ld AS (SELECT DISTINCT account, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT account, min(sent_date) AS a, max(sent_date) AS z FROM c_facts GROUP BY account, template)),
       shared AS (SELECT account, day FROM hd JOIN ld USING (account, day)),
       hs AS (SELECT h.account, count(*) AS n, count(s.day) AS n_in, sum(CASE WHEN s.day IS NOT NULL THEN revenue END) AS r FROM h LEFT JOIN shared s ON s.account = h.account AND s.day = h.day GROUP BY 1),
       ls AS (SELECT f.account, count(*) AS n, count(s.day) AS n_in, sum(CASE WHEN s.day IS NOT NULL THEN earnings END) AS r FROM c_facts f LEFT JOIN shared s ON s.account = f.account AND s.day = f.sent_date GROUP BY 1),
       ds AS (SELECT account, count(*) AS n FROM shared GROUP BY 1)
       SELECT account, coalesce(hs.n, 0) AS history_rows, coalesce(ls.n, 0) AS live_rows, coalesce(ds.n, 0) AS overlap_days, coalesce(hs.n_in, 0) AS history_rows_in, coalesce(ls.n_in, 0) AS live_rows_in,
         coalesce(hs.r, 0) AS history_revenue_in, coalesce(ls.r, 0) AS live_revenue_in FROM hs FULL JOIN ls USING (account) LEFT JOIN ds USING (account)""",
)
def _(spark, d):
    day = F.to_date("sent_at")
    history = content.backfill(landing_reports(spark, d), ing.known_names(spark, d), src.accounts(spark, d).where("is_active"))
    history = history.select("account", day.alias("day"), F.date_trunc("week", "sent_at").alias("week"), F.col("revenue").alias("value"))
    live = sem.facts(spark, d).select("account", F.col("sent_date").alias("day"), "template", F.col("earnings").alias("value"))
    found = overlap_report(history, live, ["account"], ("week", "template"), "day", "value")
    return found.withColumnsRenamed({
        "one_rows": "history_rows", "other_rows": "live_rows", "one_rows_in": "history_rows_in", "other_rows_in": "live_rows_in",
        "one_value_in": "history_revenue_in", "other_value_in": "live_revenue_in"})


# --- typed bulk load ------------------------------------------------------------------------------

BULK_SCHEMA = T.StructType([
    T.StructField("message_id", T.StringType()), T.StructField("page_name", T.StringType()), T.StructField("is_paid", T.BooleanType()),
    T.StructField("sent", T.LongType()), T.StructField("day", T.DateType()), T.StructField("note", T.StringType()),
])
_NOTE = "['N/A', 'nan', '-', 'Hello  World', message][event_id % 5 + 1]"
_FOLDED = f"regexp_replace(trim(lower({_NOTE})), '\\s+', ' ', 'g')"
_SHOWN = sql_strip_html(_NOTE)


@product(
    "bulk_loaded", "message_id kind is_paid sent:i day:d text_hash text_key shown reasons:j",
    f"""SELECT * REPLACE (CASE WHEN len(reasons) > 0 THEN reasons END AS reasons) FROM (
        SELECT CASE WHEN event_id % 13 <> 0 THEN message_id END AS message_id, ['vip', 'free', 'paid', 'main'][event_id % 4 + 1] AS kind, CASE WHEN event_id % 8 < 7 THEN event_id % 8 < 5 END AS is_paid,
          CASE WHEN event_id % 17 <> 0 THEN sent * 100 END AS sent, CASE WHEN event_id % 19 <> 0 THEN ingestion_date END AS day, sha256({_NOTE}) AS text_hash,
          sha256(CASE WHEN {_FOLDED} IN ('', 'nan', 'none', 'null', 'n/a', 'na', '-') THEN '__empty__' ELSE {_FOLDED} END) AS text_key,
          CASE WHEN lower({_SHOWN}) NOT IN ('', 'nan', 'none', 'null', 'n/a', 'na', '-') THEN {_SHOWN} END AS shown,
          list_filter([CASE WHEN event_id % 17 = 0 THEN 'sent is not bigint' END, CASE WHEN event_id % 19 = 0 THEN 'day is not date' END, CASE WHEN event_id % 13 = 0 THEN 'message_id is missing' END], lambda x: x IS NOT NULL) AS reasons
        FROM c_landing)""",
)
def _(spark, d):
    folder = place(spark, "bulk")
    rows = landing_reports(spark, d).withColumn("n", F.substring("message_id", 2, 20).cast("long")).selectExpr(
        "CASE WHEN n % 13 <> 0 THEN message_id END AS message_id",
        "concat(sender, element_at(array(' VIP', ' free', ' (paid)', ''), cast(n % 4 + 1 AS int))) AS page_name",
        "element_at(array('true', 'T', '1', 'yes', 'Y', 'no', '0', ''), cast(n % 8 + 1 AS int)) AS is_paid",
        "CASE WHEN n % 17 = 0 THEN 'many' ELSE format_number(sent * 100, 0) END AS sent",
        "CASE WHEN n % 19 = 0 THEN '2024-13-45' ELSE cast(ingestion_date AS string) END AS day",
        "element_at(array('N/A', 'nan', '-', 'Hello  World', message), cast(n % 5 + 1 AS int)) AS note")
    rows.write.options(header=True, escape='"').csv(folder)
    loaded = bulk.bulk_load(spark, folder, BULK_SCHEMA, ("message_id",))
    return loaded.select(
        "message_id", text.account_kind("page_name").alias("kind"), "is_paid", "sent", "day", hashing.stable_hash("note").alias("text_hash"),
        text.sentinel_hash("note").alias("text_key"), text.clean_text("note").alias("shown"), "reasons")


# --- run log of the library update ----------------------------------------------------------------


def logged_runs(spark, d):
    """The library takes a first delivery of half the copy, then all of it, then all of it once more."""
    folder, inflow = place(spark, "bank"), qa.inflow(spark, d)
    for run, day, rows in (("r1", "2024-01-30", inflow.where("source_id % 2 = 0")), ("r2", "2024-01-31", inflow), ("r3", "2024-01-31", inflow)):
        content.update_bank(spark, rows, f"{folder}/rows", f"{folder}/log", run, day)
    return spark.read.parquet(f"{folder}/log")


SHARED_SQL["c_runs"] = """
SELECT run_id, run_at, source_rows, inserted, source_rows - inserted AS duplicates, 0 AS errors FROM (
  SELECT 'r1' AS run_id, '2024-01-30' AS run_at, count(*) FILTER (source_id % 2 = 0) AS source_rows, count(*) FILTER (source_id % 2 = 0) AS inserted FROM c_inflow
  UNION ALL SELECT 'r2', '2024-01-31', count(*), count(*) FILTER (source_id % 2 <> 0) FROM c_inflow
  UNION ALL SELECT 'r3', '2024-01-31', count(*), 0 FROM c_inflow)"""


@product("bank_update_log", "run_id run_at source_rows:i inserted:i duplicates:i errors:i", "SELECT * FROM c_runs")
def _(spark, d):
    return logged_runs(spark, d)


@product(
    "ingestion_monitor", "run_date:d runs:i inserted:i max_inserted:i duplicates:i errors:i error_sample insertion_rate:r",
    """SELECT CAST(run_at AS DATE) AS run_date, count(*) AS runs, sum(inserted) AS inserted, max(inserted) AS max_inserted, sum(duplicates) AS duplicates, sum(errors) AS errors,
       NULL::VARCHAR AS error_sample, CASE WHEN sum(source_rows) > 0 THEN sum(inserted) / sum(source_rows) END AS insertion_rate FROM c_runs GROUP BY 1""",
)
def _(spark, d):
    return content.ingestion_monitor(logged_runs(spark, d))


# --- settings over time ---------------------------------------------------------------------------

_FIRST = [("grow", 1, "2024-01-05 00:00:00", 0.28), ("balance", 1, "2024-01-10 06:30:00", 0.5)]
_ADDED = [("balance", 1, "2024-01-10 06:30:00", 0.9), ("grow", 2, "2024-01-15 12:00:00", 0.31), ("grow", 3, "2024-01-15 18:00:00", 0.35)]
_CHANGED = [("balance", 1, "2024-01-10 06:30:00", 0.3), ("grow", 4, "2024-01-22 00:00:00", 0.2)]


def weights_table(spark):
    """Seeded, seeded again with new rows only, then changed in place."""
    made = lambda rows: spark.createDataFrame(rows, "page_state string, version int, since string, w_rps double").withColumn("since", F.to_timestamp_ntz("since"))
    keys = ["page_state", "version"]
    return settings.seeded(settings.seeded(made(_FIRST), made(_ADDED), keys), made(_CHANGED), keys, update=True)


@product(
    "settings_at_send", "page_state w_rps:r matched sends:i accounts:i earnings:r",
    """WITH v AS (SELECT *, lead(since) OVER (PARTITION BY page_state ORDER BY since) AS until FROM (VALUES ('grow', TIMESTAMP '2024-01-05 00:00:00', 0.28), ('grow', TIMESTAMP '2024-01-15 12:00:00', 0.31),
         ('grow', TIMESTAMP '2024-01-15 18:00:00', 0.35), ('grow', TIMESTAMP '2024-01-22 00:00:00', 0.2), ('balance', TIMESTAMP '2024-01-10 06:30:00', 0.3)) t(page_state, since, w_rps))
       SELECT a.page_state, coalesce(v.w_rps, 0.25) AS w_rps, v.since IS NOT NULL AS matched, count(*) AS sends, count(DISTINCT f.account) AS accounts, sum(earnings) AS earnings
       FROM c_facts f JOIN c_accounts a ON a.account = f.account LEFT JOIN v ON v.page_state = a.page_state AND v.since <= f.sent_at AND (v.until IS NULL OR f.sent_at < v.until) GROUP BY 1, 2, 3""",
)
def _(spark, d):
    sends = sem.facts(spark, d).select("account", "sent_at", "earnings").join(src.accounts(spark, d).select("account", "page_state"), "account")
    live = settings.versions(weights_table(spark), ["page_state"], "since")
    found = settings.at_time(sends, live, ["page_state"], "sent_at", ["w_rps"], {"w_rps": F.lit(0.25)}, src.EVENTS_AS_OF[:10])
    return found.groupBy("page_state", "w_rps", "matched").agg(F.count(F.lit(1)).alias("sends"), F.countDistinct("account").alias("accounts"), F.sum("earnings").alias("earnings"))
