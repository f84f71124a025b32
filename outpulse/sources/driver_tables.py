"""The given parquet tables seen as send reports, accounts and message copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.operators.joins import estimated_bytes

EVENTS_AS_OF = "2024-01-31 00:00:00"
SALES_AS_OF = "2001-12-01 00:00:00"

# One time zone per region key.
REGION_ZONES = ("America/New_York", "UTC", "Europe/Paris", "Asia/Tokyo", "America/Denver")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table; its footers are read once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


def send_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as one send per row: a narrow projection, no shuffle."""
    n = "event_id"
    copies = table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    return (
        spread(table(spark, sf_dir, "events"), "event_id")
        .withColumn("k", F.get_json_object("props", "$.k").cast("long"))
        # An account's copies are neighbours in the library, few of them sent often; all accounts together
        # use the whole of it, however large.
        .withColumn("template", F.concat(F.lit("tpl_"), (F.expr("user_id * 20 + k * k div 100") % copies).cast("string")))
        .selectExpr(
            "concat('m', event_id) AS message_id",
            "concat('acct_', user_id) AS account",
            "template",
            "concat('S', user_id % 7) AS sender",
            "ts AS sent_at",
            "to_date(ts) AS sent_date",
            f"CASE WHEN event_type = 'signup' AND {n} % 10 = 0 THEN 0L ELSE 10L + {n} % 90 END AS sent",
            f"""CASE WHEN event_type = 'error' AND {n} % 8 = 0 THEN 15L + {n} % 90
                     WHEN event_type = 'signup' AND {n} % 10 = 0 THEN 0L
                     WHEN event_type IN ('signup', 'error') THEN (10L + {n} % 90) div 5
                     ELSE (10L + {n} % 90) div 2 END AS viewed""",
            f"""CASE WHEN event_type = 'purchase' THEN 1L + {n} % 5
                     WHEN event_type = 'click' AND {n} % 4 = 0 THEN 1L ELSE 0L END AS purchased""",
            f"CASE WHEN {n} % 6 = 0 THEN 0BD ELSE cast(value AS decimal(18,2)) END AS price",
        )
        .withColumn("earnings", (F.col("price") * F.col("purchased")).cast("decimal(18,2)"))
    )


def sales_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as sends: large volume, several years of days."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS message_id",
        "concat('acct_', l_suppkey) AS account",
        "concat('tpl_', l_partkey) AS template",
        "concat('S', l_suppkey % 7) AS sender",
        """l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 AS int),
                                         cast(l_linenumber * 7 % 60 AS int)) AS sent_at""",
        "to_date(l_shipdate) AS sent_date",
        "cast(l_quantity AS bigint) AS sent",
        """CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN cast(l_quantity AS bigint) + 1
                ELSE cast(l_quantity AS bigint) div 2 END AS viewed""",
        """CASE WHEN l_returnflag = 'R' THEN 0L ELSE cast(l_quantity AS bigint) div 4 END AS purchased""",
        "cast(p_retailprice / 10 AS decimal(18,2)) AS price",
        """CASE WHEN l_returnflag = 'R' THEN 0BD ELSE
           cast(cast(p_retailprice / 10 AS decimal(18,2)) * (cast(l_quantity AS bigint) div 4)
                AS decimal(18,2)) END AS earnings""",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with its nation and region as the account dimension."""
    c = table(spark, sf_dir, "customer")
    # ``nation`` is a fixed table of 25 rows: as a map it keeps the account
    # dimension a plain scan, whose size Spark can judge for broadcasting.
    regions = (
        table(spark, sf_dir, "nation")
        .agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_regionkey"))).alias("m"))
        .scalar()
    )
    zones = F.array(*[F.lit(z) for z in REGION_ZONES])
    return (
        c.withColumn("tz", F.get(zones, regions[F.col("c_nationkey")]))
        .selectExpr(
            "concat('acct_', c_custkey) AS account",
            "c_name AS display_name",
            "element_at(array('main', 'vip', 'free'), cast(c_custkey % 3 + 1 AS int)) AS page_type",
            "tz",
            "cast(6 + c_custkey % 4 AS bigint) AS min_hour",
            "cast(18 + c_custkey % 6 AS bigint) AS max_hour",
            "c_acctbal >= -500 AS is_active",
            "concat('S', c_custkey % 7) AS assignee",
            "element_at(array('grow', 'balance', 'retain'), cast(c_custkey % 3 + 1 AS int)) AS page_state",
            """CASE WHEN c_acctbal >= 7000 THEN 'high' WHEN c_acctbal >= 3000 THEN 'medium'
                    ELSE 'low' END AS tier""",
            "cast(100 + c_custkey * 37 % 5000 AS bigint) AS active_fans",
            "cast(c_custkey % 100 AS double) / 100 AS renew_on_pct",
            "cast(3 + c_custkey % 4 AS bigint) AS daily_quota",
        )
        .withColumn("account_page", F.concat_ws("__", "account", "page_type"))
        .withColumn("is_paid", F.col("page_type") != "free")
    )


def spread(df: DataFrame, key: str, small: int = 32 << 20) -> DataFrame:
    """Spread a small table over all cores before CPU-heavy work on it.  A
    table with at least one full split per core is left as it was scanned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if estimated_bytes(df) < cores * small else df


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as the message-copy library; every copy has an owner, sent or not."""
    senders = table(spark, sf_dir, "events").agg(F.max("user_id")).scalar()
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('tpl_', doc_id) AS template",
        "doc_id",
        "text AS body",
        "source AS category",
        "lang",
    ).withColumn("owned_by", F.concat(F.lit("acct_"), (F.col("doc_id") % senders + 1).cast("string")))
