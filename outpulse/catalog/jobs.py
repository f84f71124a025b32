"""Sinks, file readers and streams: each product writes to the shared folder and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.catalog.ingest import DEDUP, NORMAL_SHAPE
from outpulse.catalog.registry import product
from outpulse.operators import ranking, upsert
from outpulse.plans import ingest
from outpulse.session import shared_folder
from outpulse.sources import driver_tables as src
from outpulse.sources import reports
from outpulse.sources.versions import VersionedTable
from outpulse.streaming import jobs

AS_OF = src.EVENTS_AS_OF


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def damaged(spark: SparkSession, d: str) -> DataFrame:
    """Reports of which some lack their id and some have an unreadable time."""
    n = F.substring("message_id", 2, 20).cast("long")
    return reports.landing_reports(spark, d).withColumns({
        "sending_time": F.when(n % 11 == 0, "soon").otherwise(F.col("sending_time")),
        "message_id": F.when(n % 13 != 0, F.col("message_id")),
    })


def as_stream(spark: SparkSession, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows as JSON files read as a stream, and a folder for its results."""
    folder = place(spark, name)
    rows.write.json(f"{folder}/in")
    return jobs.report_stream(spark, f"{folder}/in", 2), folder


def by_day(rows: DataFrame) -> DataFrame:
    """Rows in several files by day, not in order of time: some batches are late."""
    return rows.repartition(8, "ingestion_date")


@product(
    "landed_reports", "ingestion_date:d kept:i set_aside:i reasons",
    """SELECT ingestion_date, count(*) FILTER (event_id % 13 <> 0) AS kept, count(*) FILTER (event_id % 13 = 0) AS set_aside,
         max(CASE WHEN event_id % 13 = 0 THEN 'missing message_id' END) AS reasons FROM c_landing GROUP BY 1""",
)
def _(spark, d):
    path = place(spark, "landed")
    reports.land(damaged(spark, d), f"{path}/rows", f"{path}/rejects")
    kept = spark.read.parquet(f"{path}/rows").select("ingestion_date", F.lit(1).alias("k"), F.lit(0).alias("r"), F.lit(None).cast("string").alias("why"))
    bad = spark.read.parquet(f"{path}/rejects").select("ingestion_date", F.lit(0).alias("k"), F.lit(1).alias("r"), F.array_join("reasons", ",").alias("why"))
    return kept.unionByName(bad).groupBy("ingestion_date").agg(F.sum("k").alias("kept"), F.sum("r").alias("set_aside"), F.max("why").alias("reasons"))


@product(
    "csv_reports", "message_id message sending_time price viewed:i missing",
    """SELECT message_id, message, sending_time, price, viewed, 'missing run_id,missing ingested_at,missing ingestion_date,missing source_file' AS missing FROM c_landing""",
)
def _(spark, d):
    path = place(spark, "csv")
    rows = reports.landing_reports(spark, d)
    rows.select(F.col("message_id").alias("Msg ID"), F.col("message").alias("Caption"), F.col("sending_time").alias("Sent At"), F.col("price").alias("Price"),
                F.format_number("viewed", 0).alias("Views")).write.option("header", True).csv(path)
    read = reports.standardise(reports.read_text_with_fallback(spark, path).drop("source_file"))
    return reports.missing_required(read).withColumn("missing", F.array_join("reasons", ","))


@product(
    "mixed_reports", "message_id message sending_time price viewed:i sender note missing",
    """SELECT message_id, 'Café Ñandú ' || message AS message, sending_time, price, viewed, CASE WHEN event_id % 3 = 0 THEN sender END AS sender,
         CASE WHEN event_id % 3 <> 0 THEN 'n° ' || event_id END AS note, 'missing run_id,missing ingested_at,missing ingestion_date,missing source_file' AS missing FROM c_landing""",
)
def _(spark, d):
    """One folder of files in two encodings, under two headers of other names and order."""
    path, n = place(spark, "mixed"), F.substring("message_id", 2, 20).cast("long")
    rows = reports.landing_reports(spark, d).withColumn("message", F.concat(F.lit("Café Ñandú "), "message"))
    views = F.format_number("viewed", 0)
    rows.where(n % 3 == 0).select(
        F.col("message_id").alias("Msg ID"), F.col("message").alias("Caption"), F.col("sending_time").alias("Sent At"), F.col("price").alias("Price"), views.alias("Views"),
        F.col("sender").alias("Sent By")).write.option("header", True).csv(path)
    rows.where(n % 3 != 0).select(
        views.alias("view count"), F.concat(F.lit("n° "), n.cast("string")).alias("Note"), F.col("price").alias("Amount"), F.col("message").alias("TEXT"),
        F.col("message_id").alias("id"), F.col("sending_time").alias("timestamp")).write.mode("append").options(header=True, encoding="ISO-8859-1").csv(path)
    read = reports.standardise(reports.read_text_with_fallback(spark, path).drop("source_file"))
    return reports.missing_required(read).withColumn("missing", F.array_join("reasons", ","))


@product("upserted_facts", NORMAL_SHAPE + " run_id", "SELECT * FROM o_report_fact_upsert")
def _(spark, d):
    path = place(spark, "facts")
    rows = reports.landing_reports(spark, d)
    for first, last in (("2024-01-01", "2024-01-20"), ("2024-01-15", "2024-01-31"), ("2024-01-15", "2024-01-31")):  # the last batch again changes nothing
        upsert.upsert_versions(spark, path, ingest.normalised_reports(rows, first, last), ["send_key"], "sent_date", "ingested_at", "message_id")
    return VersionedTable(spark, path, "sent_date").read()


@product("streamed_landing", "ingestion_date:d messages:i", "SELECT ingestion_date, count(*) AS messages FROM c_landing WHERE event_id % 13 <> 0 GROUP BY 1")
def _(spark, d):
    stream, folder = as_stream(spark, damaged(spark, d), "stream-land")
    jobs.land_stream(stream, f"{folder}/out", f"{folder}/ck")
    return spark.read.parquet(f"{folder}/out").groupBy("ingestion_date").agg(F.count("*").alias("messages"))


@product(
    "streamed_rejects", "message sender reason",
    """SELECT message, sender, CASE WHEN event_id % 13 = 0 THEN 'missing message_id' ELSE 'unreadable send time' END AS reason
       FROM c_landing WHERE event_id % 13 = 0 OR event_id % 11 = 0""",
)
def _(spark, d):
    stream, folder = as_stream(spark, damaged(spark, d), "stream-rejects")
    jobs.rejected_stream(stream, f"{folder}/out", f"{folder}/ck")
    return spark.read.parquet(f"{folder}/out")


@product(
    "streamed_facts", "send_key message_id price:r sent:i sent_date:d quarantined:i",
    f"""SELECT *, (SELECT count(*) FROM c_normal WHERE sent_date < DATE '2024-01-03') AS quarantined FROM
        (SELECT * FROM c_normal WHERE sent_date >= DATE '2024-01-03' {DEDUP})""",
)
def _(spark, d):
    stream, folder = as_stream(spark, reports.landing_reports(spark, d), "stream-facts")
    jobs.upsert_stream(stream, f"{folder}/out", f"{folder}/ck", f"{folder}/bad", "2024-01-03", "2024-12-31")
    bad = spark.read.parquet(f"{folder}/bad").agg(F.count("*")).scalar()
    return VersionedTable(spark, f"{folder}/out", "sent_date").read().withColumn("quarantined", bad)


@product(
    "streamed_daily_totals", "day:d sender messages:i sent:i revenue:r",
    """SELECT CAST(sent_at AS DATE) AS day, sender, count(*) AS messages, sum(sent) AS sent, sum(revenue) AS revenue FROM c_parsed
       WHERE CAST(sent_at AS DATE) + INTERVAL 1 DAY <= (SELECT max(sent_at) FROM c_parsed) - INTERVAL 7 DAY GROUP BY 1, 2""",
)
def _(spark, d):
    stream, folder = as_stream(spark, by_day(reports.landing_reports(spark, d)), "stream-daily")
    jobs.daily_totals_stream(stream, f"{folder}/out", f"{folder}/ck")
    return jobs.daily_totals(spark, f"{folder}/out")


@product(
    "streamed_daily_counts", "kept:i set_aside:i late:i",
    """SELECT count(*) FILTER (event_id % 11 <> 0) AS kept, count(*) FILTER (event_id % 11 = 0) AS set_aside, 0 AS late FROM c_landing""",
)
def _(spark, d):
    """Two runs over one table: kept and set aside are all rows, of which some have no readable time."""
    rows = damaged(spark, d)
    half = F.col("ingestion_date") < "2024-01-16"
    folder = place(spark, "stream-counts")
    for n, part in enumerate((rows.where(half), rows.where(~half))):  # in order of time: no row is late
        part.write.mode("append").json(f"{folder}/in")
        jobs.daily_totals_stream(jobs.report_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/ck")
    totals = jobs.daily_totals(spark, f"{folder}/out", still_open=True).agg(F.sum("messages").alias("kept"), F.sum("late_messages").alias("late"))
    return totals.withColumn("set_aside", jobs.daily_tables(spark, f"{folder}/out")[1].read().agg(F.count("*")).scalar())


@product("streamed_first_seen", "message_id", "SELECT message_id FROM c_landing")
def _(spark, d):
    rows = reports.landing_reports(spark, d)
    stream, folder = as_stream(spark, by_day(rows.unionByName(rows)), "stream-first")
    jobs.first_seen_stream(stream, f"{folder}/out", f"{folder}/ck")
    return spark.read.parquet(f"{folder}/out")


@product("replaced_days", "sent_date:d account messages:i",
         "SELECT sent_date, account, CASE WHEN sent_date >= DATE '2024-01-20' THEN count(*) ELSE -count(*) END AS messages FROM c_facts GROUP BY 1, 2")
def _(spark, d):
    path = place(spark, "days")
    rows = src.send_facts(spark, d).groupBy("sent_date", "account").agg(F.count("*").alias("messages"))
    days = VersionedTable(spark, path, "sent_date")
    days.overwrite(rows.withColumn("messages", -F.col("messages")))
    days.replace(rows.where("sent_date >= DATE'2024-01-20'"))
    return days.read()


@product("week_snapshot", "week_start:d account tier", "SELECT DATE '2024-01-29' AS week_start, account, tier FROM c_accounts")
def _(spark, d):
    path = place(spark, "week")
    for _ in range(2):  # the second run replaces the week
        reports.append_week(src.accounts(spark, d).select("account", "tier"), path, AS_OF)
    return spark.read.parquet(path)


@product("exported_categories", "category templates:i exported:i", "SELECT category, count(*) AS templates, count(*) AS exported FROM c_templates GROUP BY 1")
def _(spark, d):
    path = place(spark, "export")
    counts = reports.export_by_category(src.templates(spark, d).select("template", "lang", "category"), path, "category")
    files = spark.read.option("header", True).csv(path).groupBy("category").agg(F.count("*").alias("exported"))
    return counts.withColumnRenamed("count", "templates").join(files, "category")


@product("price_medians", "account median_price:r", "SELECT account, median(price::DOUBLE) AS median_price FROM c_facts GROUP BY 1")
def _(spark, d):
    return ranking.medians(src.send_facts(spark, d).select("account", F.col("price").cast("double").alias("price")), ["account"], "price", "median_price")
