"""Keyed merges over plain files: the winning row per key, then a rewrite of
only the date partitions a batch touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.operators.ranking import first_per_key
from outpulse.session import stabilise
from outpulse.sources.versions import VersionedTable


def newest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return first_per_key(df, keys, order)


def merged(
    target: DataFrame, batch: DataFrame, keys: list[str], freshness: str, tie: str
) -> DataFrame:
    """Target after an upsert: a batch row replaces a target row only when it
    is strictly fresher; unmatched batch rows are added."""
    t = target.withColumn("_incoming", F.lit(0))
    b = batch.withColumn("_incoming", F.lit(1))
    order = [F.col(freshness).desc(), F.col("_incoming").asc(), F.col(tie).desc()]
    return first_per_key(t.unionByName(b), keys, order).drop("_incoming")


def merged_any(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target after an upsert in which the batch always wins."""
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(batch)


def added_only(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Insert-only merge: the batch rows whose key the target does not have."""
    return first_per_key(batch.join(target.select(*keys), keys, "left_anti"), keys, order)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    partition: str,
    freshness: str,
    tie: str,
) -> None:
    """Merge ``batch`` into the parquet table at ``path``.

    Only partitions named by the batch are read (a plain IN list on the
    partition column, so the scan prunes) and overwritten dynamically.
    Re-running the same batch leaves the table unchanged.
    """
    days = [r[0] for r in batch.select(partition).distinct().collect()]  # one value per date
    if not days:
        return
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    exists = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    rows = batch
    if exists:
        old = spark.read.schema(batch.schema).parquet(path).where(F.col(partition).isin(days))
        rows = merged(old.select(*batch.columns), batch, keys, freshness, tie)
    # The old files are read and replaced in one step, so the rows are fixed first.
    (
        stabilise(rows)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def upsert_versions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str],
    partition: str,
    freshness: str,
    tie: str,
    marks: dict[str, str] | None = None,
) -> None:
    """``upsert_partitions`` for a versioned table: readers see all of the batch or nothing of it.

    The batch is computed once, only the folders of its partitions are read, and
    one rename publishes them.  ``marks`` note in the same commit what is done.
    """

    def merge(old: DataFrame | None, rows: DataFrame) -> DataFrame:
        if old is None:
            return first_per_key(rows, keys, [F.col(freshness).desc(), F.col(tie).desc()])
        return merged(old.select(*rows.columns), rows, keys, freshness, tie)

    VersionedTable(spark, path, partition).change(batch, merge, marks)
