"""Corpus pipeline: toxic documents out, bad ones out, one of each near-duplicate group, packed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.llm import near_dedup, packing, quality, toxicity
from outpulse.llm.common import read, shared_dir
from outpulse.llm.queries import vocabulary


def accepted(docs: DataFrame, score, labels: DataFrame, predicted: int) -> DataFrame:
    """The whole rows that ``score`` predicts so; they travel as one column, so that no name of theirs clashes."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "doc_id", "text")
    return score(rows, labels).where(F.col("predicted") == predicted).select("_row.*")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labelled ones among them, does not reject."""
    return accepted(docs, toxicity.score, read(spark, sf_dir, "labels"), 0)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    return accepted(docs, quality.score, read(spark, sf_dir, "labels"), 1)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id; ids may be missing or shared."""
    return near_dedup.representatives(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, in sequences of at most 2048 tokens."""
    return packing.pack(docs, vocabulary("words"))


STAGES = [("toxicity", without_toxic), ("quality", of_quality), ("near_dedup", without_near_copies), ("packing", packed)]
ORACLE_SQL = None  # learnt scores, signatures and tokenizers are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
