"""Registered products: one output shape drives the Spark and the SQL side.

A shape lists columns as ``name`` or ``name:kind``: ``r`` real (rounded to six
places), ``i`` integer, ``d`` date and ``t`` timestamp (both
shown as text), ``j`` array (joined by commas).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.session import stabilise

PRODUCTS: dict[str, "Product"] = {}
SHARED_SQL: dict[str, str] = {}
# Shown reals are nudged before rounding, on both sides: engines disagree on
# exact halves (x.xxxxxx5), which ratios by powers of two do produce.  NaN (a
# correlation without variance) shows as NULL and minus zero as zero.
NUDGE = 1.00000000001
SHOWN = "round(CAST({0} AS DOUBLE) * 1.00000000001, 6)"


@dataclass(frozen=True)
class Product:
    name: str
    shape: tuple[tuple[str, str], ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        kinds = {
            "r": lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.round(F.col(c).cast("double") * NUDGE, 6)),
            "i": lambda c: F.col(c).cast("long"),
            "d": lambda c: F.date_format(c, "yyyy-MM-dd"),
            "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
            "j": lambda c: F.array_join(c, ","),
            "": lambda c: F.col(c),
        }
        df = self.run(spark, sf_dir)
        return df.select(*[kinds[k](c).alias(c) for c, k in self.shape])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        kinds = {
            "r": f"CASE WHEN isnan({SHOWN}) THEN NULL WHEN {SHOWN} = 0 THEN 0.0::DOUBLE ELSE {SHOWN} END",
            "i": "CAST({0} AS BIGINT)",
            "d": "strftime({0}, '%Y-%m-%d')",
            "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
            "j": "array_to_string({0}, ',')",
            "": "{0}",
        }
        cols = ", ".join(f"{kinds[k].format(c)} AS {c}" for c, k in self.shape)
        return f"{with_clause(self.sql)} SELECT {cols} FROM ({self.sql}) AS answer"


def with_clause(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in SHARED_SQL:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(SHARED_SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return ""
    return "WITH " + ", ".join(f"{n} AS ({SHARED_SQL[n]})" for n in needed)


def product(name: str, shape: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; its SQL is reusable as ``o_<name>``."""
    columns = tuple(tuple((c + ":").split(":")[:2]) for c in shape.split())

    def register(fn):
        if name in PRODUCTS:
            raise ValueError(f"{name} is registered twice")
        PRODUCTS[name] = Product(name, columns, fn, sql)
        if sql is not None:
            SHARED_SQL[f"o_{name}"] = sql
        return fn

    return register


_LAYERS: dict[tuple[str, str, str], DataFrame] = {}


def is_stored(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether this session has the layer already, so that reading it costs nothing more."""
    return (spark.sparkContext.applicationId, sf_dir, name) in _LAYERS


def layer(name: str):
    """Mark a builder as a stored layer: like a table of the warehouse it is
    materialised once per session and folder, and later queries read it."""

    def wrap(build):
        def read(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _LAYERS:
                _LAYERS[key] = stabilise(build(spark, sf_dir))
            return _LAYERS[key]

        return read

    return wrap
