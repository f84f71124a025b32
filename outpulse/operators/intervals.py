"""Sweeps over interval ends: what is open at a time, without joining intervals to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outpulse.operators.ordered import sliced
from outpulse.operators.ranking import null_safe


def ends(intervals: DataFrame, keys: list[str], first: str, last: str, name: str) -> DataFrame:
    """One row per key and day on which intervals (closed, of days) start or have ended: their net number in ``name``."""
    start = intervals.select(*keys, F.col(first).alias("day"), F.lit(1).alias(name))
    stop = intervals.select(*keys, F.date_add(last, 1).alias("day"), F.lit(-1).alias(name))
    return start.unionByName(stop).where("day IS NOT NULL").groupBy(*keys, "day").agg(F.sum(name).alias(name))


def open_counts(changes: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Running sums of ``names`` over the days of a key, and ``days`` up to the key's next row (last: 0).

    ``changes`` has one row per key and day at most.  The sums run inside slices
    of about equal rows; only each slice's totals and first day travel to the
    key's other slices, so the rows of a hot key are several tasks' work.
    """
    rows = sliced(changes, keys, ["day"])
    inside = Window.partitionBy(*keys, "_c").orderBy("day")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_next", F.lead("day").over(inside)).withColumns({f"_{n}": F.sum(n).over(running) for n in names})
    slices = rows.groupBy(*keys, "_c").agg(F.min("day").alias("_first"), *[F.sum(n).alias(f"_t_{n}") for n in names])
    over = Window.partitionBy(*keys).orderBy("_c")  # one row per slice
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carry = slices.select(
        *keys, "_c", F.lead("_first").over(over).alias("_then"), *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in names])
    out = null_safe(rows, carry, [*keys, "_c"])
    days = F.coalesce(F.datediff(F.coalesce("_next", "_then"), "day"), F.lit(0))
    kept = [c for c in changes.columns if c not in names]
    return out.select(*kept, days.alias("days"), *[(F.col(f"_{n}") + F.col(f"_b_{n}")).alias(n) for n in names])


def overlap_report(
    one: DataFrame, other: DataFrame, keys: list[str], loads: tuple[str, str], day: str, value: str,
) -> DataFrame:
    """Per key: rows of both sides, days on which both have an open load, rows and value of both on such days.

    A load is what shares a value of the side's column in ``loads``; it is open from
    its first to its last ``day``.  Loads of one side may overlap each other.
    """
    changes = None
    for side, rows, load in (("one", one, loads[0]), ("other", other, loads[1])):
        rows = rows.where(F.col(day).isNotNull())
        spans = rows.groupBy(*keys, load).agg(F.min(day).alias("_a"), F.max(day).alias("_z"))
        counted = rows.groupBy(*keys, F.col(day).alias("day")).agg(F.count(F.lit(1)).alias(f"{side}_rows"), F.sum(value).alias(f"{side}_value"))
        for part in (ends(spans, keys, "_a", "_z", f"{side}_open"), counted):
            changes = part if changes is None else changes.unionByName(part, allowMissingColumns=True)
    whole = changes.groupBy(*keys, "day").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in changes.columns if c not in (*keys, "day")])
    both = (F.col("one_open") > 0) & (F.col("other_open") > 0)
    counts = open_counts(whole, keys, ["one_open", "other_open"])
    shared = lambda c: F.sum(F.when(both, F.col(c)).otherwise(0))
    return counts.groupBy(*keys).agg(
        F.sum("one_rows").alias("one_rows"), F.sum("other_rows").alias("other_rows"), shared("days").alias("overlap_days"),
        *[shared(f"{side}_{what}").alias(f"{side}_{what}_in") for side in ("one", "other") for what in ("rows", "value")])
