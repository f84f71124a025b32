"""Typed bulk load of CSV files: rows that fit the schema, and the others whole with the reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.functions.text import truthy

SURPLUS = "_surplus"


def typed(name: str, kind: T.DataType) -> tuple[Column, Column]:
    """The typed value of a text column, and why a given text is not one (NULL: it is, or there is none)."""
    text = F.trim(F.col(name))
    given = text.isNotNull() & (text != "")
    if isinstance(kind, T.StringType):
        return F.col(name), F.lit(None).cast("string")
    if isinstance(kind, T.BooleanType):
        return truthy(name), F.lit(None).cast("string")
    bare = F.regexp_replace(text, r"[,\s]", "") if isinstance(kind, (T.NumericType,)) else text
    value = bare.try_cast(kind)
    return F.when(given, value), F.when(given & value.isNull(), F.lit(f"{name} is not {kind.simpleString()}"))


def bulk_load(spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = (), multiline: bool = False) -> DataFrame:
    """CSV files with a header, by position, in one pass: typed columns, ``reasons`` and ``raw``.

    Rows that end early have NULL there; a row with surplus values, an
    unreadable one or none in a ``required`` column keeps its texts in ``raw``
    (JSON) and says why in ``reasons``; of all others both are NULL.  So every
    row of the files is there once: loaded where ``reasons`` is NULL, else set aside.
    ``multiline`` allows line breaks inside quotes; such files are not split.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(SURPLUS, T.StringType())])
    raw = spark.read.schema(texts).options(header=True, enforceSchema=True, mode="PERMISSIVE", multiLine=multiline, escape='"').csv(path)
    parsed = [(f, *typed(f.name, f.dataType)) for f in schema]
    lacking = [F.when(value.isNull() | (value.cast("string") == ""), F.lit(f"{f.name} is missing")) for f, value, _ in parsed if f.name in required]
    found = F.filter(F.array(F.when(F.col(SURPLUS).isNotNull(), F.lit("surplus values")), *[why for _, _, why in parsed], *lacking), lambda x: x.isNotNull())
    whole = F.to_json(F.struct(*[f.name for f in schema], SURPLUS))
    bad = F.size("_why") > 0
    return raw.withColumn("_why", found).select(
        *[value.alias(f.name) for f, value, _ in parsed], F.when(bad, F.col("_why")).alias("reasons"), F.when(bad, whole).alias("raw"))
