"""Incremental runs: landing files as a stream, upserts and daily totals.

Every job takes its own checkpoint folder, keeps processed inputs there and
gives the same result for any split of the input into batches.
"""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from outpulse.functions import clock
from outpulse.functions.numeric import ratio
from outpulse.operators import upsert
from outpulse.plans import ingest
from outpulse.session import stabilise
from outpulse.sources.reports import LANDING_SCHEMA
from outpulse.sources.versions import VersionedTable

HORIZON = "7 days"


def report_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """JSON report exports as a stream; a file is read once, ever."""
    return (
        spark.readStream.schema(LANDING_SCHEMA).option("mode", "PERMISSIVE").option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def _wait(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query


def land_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to the landing table, one folder per ingestion day."""
    return _wait(
        stream.dropna("any", subset=list(REQUIRED))
        .writeStream.format("parquet").outputMode("append").partitionBy("ingestion_date")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_stream(
    stream: DataFrame, path: str, checkpoint: str, quarantine_path: str, first_day: str, last_day: str
) -> StreamingQuery:
    """Normalise each batch and merge it into the versioned fact table.

    A batch rewrites only the send dates it holds, with a freshness guard, and
    publishes them at once with its number, so one that runs again after a
    failure changes nothing and readers never see half of one.  Raw rows whose send time is
    unreadable or outside the accepted range go to quarantine with the reason.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Split on the raw rows: what cannot be used keeps every original value.
        day = F.to_date(clock.parse_report_time("sending_time"))
        ok = F.coalesce(day.between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")), F.lit(False))
        rows = stabilise(batch.withColumn("_ok", ok))
        bad = rows.where("NOT _ok").drop("_ok")
        reason = F.when(day.isNull(), "unreadable send time").otherwise("send date out of range")
        bad = bad.select(reason.alias("reason"), "message_id", F.to_json(F.struct(*bad.columns)).alias("raw_data"), F.lit(batch_id).alias("batch_id"))
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine_path)
        mark = _once(VersionedTable(spark, path, "sent_date"), checkpoint, batch_id)
        if mark is not None:
            good = ingest.normalised_reports(rows.where("_ok").drop("_ok"), "1900-01-01", "9999-12-31")
            upsert.upsert_versions(spark, path, good, ["send_key"], "sent_date", "ingested_at", "message_id", mark)

    return _wait(stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


REQUIRED = ("message_id", "source_file", "ingested_at")


def rejected_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """What ``land_stream`` and ``daily_totals_stream`` cannot use, as raw rows with the reason."""
    lacking = F.array_join(F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED]), lambda r: r.isNotNull()), ", ")
    reason = F.when(lacking != "", lacking).when(clock.parse_report_time("sending_time").isNull(), "unreadable send time")
    return _wait(
        stream.withColumn("reason", reason).where("reason IS NOT NULL")
        .writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _once(table: VersionedTable, checkpoint: str, batch_id: int) -> dict[str, str] | None:
    """The mark that a commit of this batch leaves in the table; None where it is there, that is, the batch runs again."""
    key = f"stream:{checkpoint}"
    return None if int(table.manifest().marks.get(key, -1)) >= batch_id else {key: str(batch_id)}


def daily_tables(spark: SparkSession, path: str) -> tuple[VersionedTable, VersionedTable]:
    """The totals by day, and the rows set aside by batch."""
    return VersionedTable(spark, f"{path}/totals", "day"), VersionedTable(spark, f"{path}/aside", "batch_id")


PARTS = ("messages", "late_messages", "sent", "purchased", "revenue")


def daily_totals_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Sends per sender and day, kept up to date by every trigger.

    The state is the table of totals itself, a version folder per day: a batch
    is summed first, then added to the folders of its days only, and one rename
    publishes them together with the number of the batch.  So readers follow
    while the stream runs, a batch that runs again adds nothing, and its cost
    follows the days it holds and not the history.  A late row counts in its day
    whenever it comes, and in ``late_messages`` if the day was closed by then.
    Rows without a readable time are set aside whole: kept and set aside are all rows.
    """
    spark = stream.sparkSession
    totals, aside = daily_tables(spark, path)

    def add(batch: DataFrame, batch_id: int) -> None:
        at = clock.parse_report_time("sending_time")
        mark = _once(aside, checkpoint, batch_id)
        if mark is not None:
            bad = batch.where(at.isNull()).select(
                F.lit("unreadable send time").alias("reason"), "message_id", F.to_json(F.struct(*batch.columns)).alias("raw_data"), F.lit(batch_id).cast("long").alias("batch_id")
            )
            aside.replace(bad, marks=mark)
        mark = _once(totals, checkpoint, batch_id)
        if mark is None:
            return
        latest = totals.manifest().marks.get("latest")
        closed = F.date_add(F.to_date("sent_at"), 1).cast("timestamp_ntz") <= F.lit(latest).cast("timestamp_ntz") - F.expr(f"INTERVAL {HORIZON}")
        sums = stabilise(
            ingest.parsed_reports(batch).where(F.col("sent_at").isNotNull()).groupBy(F.to_date("sent_at").alias("day"), "sender")
            .agg(
                F.count(F.lit(1)).alias("messages"), F.coalesce(F.count_if(closed), F.lit(0)).alias("late_messages"), F.sum("sent").alias("sent"),
                F.sum("purchased").alias("purchased"), F.sum("revenue").alias("revenue"), F.max("sent_at").alias("latest"),
            )
        )
        newest = sums.agg(F.date_format(F.max("latest"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        mark["latest"] = max(filter(None, (latest, newest)), default="")

        def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
            both = new if old is None else old.unionByName(new)
            return both.groupBy("day", "sender").agg(*[F.sum(c).cast(new.schema[c].dataType).alias(c) for c in PARTS], F.max("latest").alias("latest"))

        totals.change(sums, merge, mark)

    return _wait(stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def daily_totals(spark: SparkSession, path: str, still_open: bool = False) -> DataFrame | None:
    """The totals of days older than the horizon, of which only the folders are read; with ``still_open`` of all days."""
    table = daily_tables(spark, path)[0]
    now = table.manifest()
    days = None
    if not still_open:
        until = dt.datetime.fromisoformat(now.marks["latest"]) - dt.timedelta(days=int(HORIZON.split()[0])) if now.marks.get("latest") else None
        days = [d for d in now.parts if until and dt.datetime.fromisoformat(d) + dt.timedelta(days=1) <= until]
    rows = table.read(days, now)
    return rows if rows is None else rows.select("day", "sender", "messages", "late_messages", "sent", ratio("purchased", "sent").alias("purchase_rate"), "revenue")


STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def first_in_batch(rows: DataFrame, key: str) -> DataFrame:
    """One row of each key per Arrow batch, so that of a hot key few rows are shuffled."""

    def keep(batches):
        for batch in batches:
            at = pa.table([batch.column(key), pa.array(range(batch.num_rows))], ["k", "at"]).group_by("k").aggregate([("at", "min")])
            yield batch.take(at.column("at_min").combine_chunks())

    return rows.mapInArrow(keep, rows.schema)


def first_seen_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the first copy of each message id, however late it or a copy comes.

    The ids of all time are keyed state on disk (RocksDB, its changes saved in
    the shared checkpoint after each batch): a batch looks its own ids up and
    writes the new ones, so its cost follows the batch and not the history.
    """
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:  # the query keeps the settings it was started with
        query = (
            first_in_batch(stream, "message_id").dropDuplicates(["message_id"])
            .writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return _wait(query)


def refresh_if_stale(latest: DataFrame, ts: str, as_of: str, hours: int, job) -> bool:
    """Run ``job()`` when the newest ``ts`` is older than ``hours``; one row is read."""
    age = latest.agg(F.timestamp_diff("HOUR", F.max(ts), F.to_timestamp_ntz(F.lit(as_of))).alias("age")).first()["age"]
    if age is not None and age <= hours:
        return False
    job()
    return True
