"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "outpulse", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator assumes (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see.

    On a cluster without that setting this is an error, since a folder of one
    machine cannot be read by the others; only in local mode is one made.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="outpulse-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stabilise(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder.

    Used where several branches read the same aggregate: a recomputed sum of
    doubles may differ in its last bit, and a lost executor must not change
    which rank bucket a row falls into.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
