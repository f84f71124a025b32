"""Delivery reports: reading, header mapping, landing and sinks."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.session import stabilise
from outpulse.sources.driver_tables import spread, table

LANDING_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampNTZType(), False),
        T.StructField("ingestion_date", T.DateType(), False),
        T.StructField("message_id", T.StringType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("message", T.StringType()),
        T.StructField("sending_time", T.StringType()),
        T.StructField("sender", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("sent", T.LongType()),
        T.StructField("viewed", T.LongType()),
        T.StructField("purchased", T.LongType()),
        T.StructField("earnings", T.StringType()),
    ]
)
REQUIRED = [f.name for f in LANDING_SCHEMA if not f.nullable]

# Report header synonyms per landing column.
SYNONYMS = {
    "message": ["message", "caption", "text", "content", "message_text"],
    "sending_time": ["sending_time", "sent_time", "time", "date", "sent_at", "timestamp"],
    "sender": ["sender", "sent_by", "scheduler", "from"],
    "price": ["price", "ppv_price", "amount", "cost"],
    "sent": ["sent", "sent_count", "total_sent", "recipients"],
    "viewed": ["viewed", "views", "view_count", "opened"],
    "purchased": ["purchased", "purchases", "sales", "bought"],
    "earnings": ["earnings", "revenue", "total_earnings", "income"],
    "message_id": ["message_id", "id", "msg_id"],
}


def header_name(raw: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9]+", "_", raw.strip().lower())).strip("_") or "column"


def unique_headers(names: Iterable[str]) -> list[str]:
    """Normalised names; repeats become name_2, name_3, ..."""
    seen: dict[str, int] = {}
    out = []
    for raw in names:
        base = header_name(raw)
        seen[base] = seen.get(base, 0) + 1
        out.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return out


MOST_HEADERS = 10_000  # different header lines in one folder


def read_text_with_fallback(spark: SparkSession, path: str) -> DataFrame:
    """CSV files, each under its own header and in its own encoding, every column text, with file and row id.

    A file is read as UTF-8 where all its lines decode, else as Latin-1.  Its
    first line that is not blank is its header; the result has the columns of
    all headers, NULL where a file lacks one, and a repeat of the header inside
    a file is no row.  Lines are split before they are decoded, so a large file
    is many tasks; a quoted value may hold no line break.  One pass finds
    headers and encodings, another reads the rows.  Only the different header
    lines reach the driver, and more than ``MOST_HEADERS`` are an error.
    """
    bare = F.col("value").cast("binary")  # the text source keeps the bytes of a line as they are
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(
        bare.alias("line"), F.is_valid_utf8("value").alias("valid"), F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start"))
    ordered = lines.withColumn("at", F.monotonically_increasing_id()).withColumn("at", F.when(F.col("start") == 0, F.col("at")))
    files = stabilise(ordered.groupBy("source_file").agg(F.min_by("line", "at").alias("header"), F.bool_and("valid").alias("utf8")))
    found = files.select("header", "utf8").distinct().limit(MOST_HEADERS + 1).collect()
    if len(found) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers in {path}")
    heads = [(r.header, r.utf8, unique_headers(next(csv.reader([bytes(r.header).decode("utf-8-sig" if r.utf8 else "latin-1")])))) for r in found]
    columns = list(dict.fromkeys(name for _, _, names in heads for name in names))
    places = [(h, u, [names.index(c) if c in names else -1 for c in columns]) for h, u, names in heads]
    few = F.broadcast(spark.createDataFrame(places, "header binary, utf8 boolean, places array<int>"))  # MOST_HEADERS rows
    rows = lines.join(files.join(few, ["header", "utf8"]), "source_file").where(F.col("line") != F.col("header"))
    text = F.when(F.col("utf8"), F.decode("line", "UTF-8")).otherwise(F.decode("line", "ISO-8859-1"))
    width = max((len(names) for _, _, names in heads), default=1)
    cells = rows.select("source_file", "places", F.from_csv(text, ", ".join(f"c{i} string" for i in range(width))).alias("c"))
    cells = cells.select("source_file", "places", F.array(*[F.col(f"c.c{i}") for i in range(width)]).alias("cells"))
    named = cells.select("source_file", *[F.get("cells", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(columns)])
    return named.dropna("all", subset=columns).withColumn("row_id", F.sha2(F.to_json(F.struct("source_file", *columns)), 256))


def standardise(df: DataFrame) -> DataFrame:
    """Map header synonyms to landing columns in one projection; missing ones
    are NULL of the right type, unknown ones are kept at the end."""
    have = set(df.columns)
    used: set[str] = set()
    out = []
    for fld in LANDING_SCHEMA:
        names = [n for n in SYNONYMS.get(fld.name, [fld.name]) if n in have]
        used.update(names)
        value = F.coalesce(*[F.col(n).cast("string") for n in names]) if names else F.lit(None)
        if isinstance(fld.dataType, T.LongType):
            value = F.regexp_replace(value.cast("string"), r"[,\s]", "").try_cast("double")
        out.append(value.cast(fld.dataType).alias(fld.name))
    extras = [c for c in df.columns if c not in used and c not in {f.name for f in LANDING_SCHEMA}]
    return df.select(*out, *extras)


def missing_required(df: DataFrame) -> DataFrame:
    """Rows that break the landing contract, with the reason."""
    reasons = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED]),
        lambda r: r.isNotNull(),
    )
    return df.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def land(df: DataFrame, path: str, rejects_path: str | None = None) -> None:
    """Append to the landing table, one directory per ingestion day.

    Rows that lack a required value go to ``rejects_path``, whole and with the
    reasons; without such a path a batch with bad rows is refused.
    """
    lacking = [f.name for f in LANDING_SCHEMA if f.name not in df.columns]
    if lacking:
        raise ValueError(f"landing batch lacks {lacking}")
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in LANDING_SCHEMA])
    bad = missing_required(rows)
    if rejects_path is not None:
        bad.write.mode("append").parquet(rejects_path)
    elif not bad.isEmpty():
        raise ValueError("rows lack required values; name a path for them")
    rows.dropna("any", subset=REQUIRED).hint("rebalance", "ingestion_date").write.mode("append").partitionBy("ingestion_date").parquet(path)


def write_table(df: DataFrame, path: str, partition: str, cluster: list[str]) -> None:
    """Create-or-replace, partitioned by date and sorted inside files."""
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, *cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition
    ).parquet(path)


def append_week(df: DataFrame, path: str, as_of: str) -> None:
    """Add a snapshot stamped with the Monday of the week; a second run of the week replaces it."""
    stamped = df.withColumn("week_start", F.to_date(F.date_trunc("week", F.lit(as_of))))
    replace_partitions(stamped, path, "week_start")


def export_by_category(df: DataFrame, path: str, category: str) -> DataFrame:
    """One CSV folder per category; returns the counts table."""
    df.write.mode("overwrite").option("header", True).partitionBy(category).csv(path)
    return df.groupBy(category).count()


def landing_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` dressed as report rows: money and times are text."""
    events = spread(table(spark, sf_dir, "events"), "event_id")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    keys = parts.agg(F.struct(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))).scalar()
    joined = events.join(parts, F.expr("event_id * 7") % keys["n"] + keys["first"] == F.col("p_partkey")).join(
        people, events.user_id == people.c_custkey
    )
    money = "concat('$', format_number({}, '#,##0.00'))"
    return joined.selectExpr(
        "concat('run_', date_format(ts, 'yyyyMMdd')) AS run_id",
        "ts + interval 1 hour AS ingested_at",
        "to_date(ts + interval 1 hour) AS ingestion_date",
        "concat('m', event_id) AS message_id",
        "concat('reports/', c_name, '_', date_format(ts, 'yyyy-MM-dd'), '.xlsx') AS source_file",
        "concat('<b>', c_name, '</b>: ', p_name, '  ', lower(p_type), ' by ', p_brand) AS message",
        "date_format(ts, \"MMM d, yyyy 'at' h:mm a\") AS sending_time",
        "concat('S', user_id % 7) AS sender",
        f"""CASE WHEN event_id % 6 = 0 THEN 'N/A' WHEN event_id % 50 = 1 THEN concat('(', {money.format('value')}, ')')
                 ELSE {money.format('value')} END AS price""",
        "10L + event_id % 90 AS sent",
        "(10L + event_id % 90) div 2 AS viewed",
        "CASE WHEN event_type = 'purchase' THEN 1L + event_id % 5 ELSE 0L END AS purchased",
        f"""CASE WHEN event_type = 'purchase' THEN {money.format('value * (1 + event_id % 5) * 3')}
                 ELSE '' END AS earnings""",
    )
