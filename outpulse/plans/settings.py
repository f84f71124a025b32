"""Settings over time: seeds of a settings table, validity of its versions, and the version live at a row's time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.operators.joins import salted_lookup
from outpulse.operators.ranking import first_per_key


def seeded(table: DataFrame, seed: DataFrame, keys: list[str], update: bool = False) -> DataFrame:
    """``table`` with the rows of ``seed``: only those of new keys, or (``update``) in place of the table's."""
    kept, other = (seed, table) if update else (table, seed)
    return kept.unionByName(other.join(kept.select(*keys), keys, "left_anti"))


def versions(settings: DataFrame, keys: list[str], since: str) -> DataFrame:
    """Adds ``valid_from`` and ``valid_to`` (NULL: still valid) to the versions of each key; of equal times the last row's id wins.

    A settings table has few rows per key, so a plain window does.
    """
    one = first_per_key(settings.where(F.col(since).isNotNull()), [*keys, since], [F.col("version").desc()])
    return one.withColumn("valid_from", F.col(since)).withColumn("valid_to", F.lead(since).over(Window.partitionBy(*keys).orderBy(since)))


def at_time(rows: DataFrame, live: DataFrame, keys: list[str], at: str, values: list[str], defaults: dict[str, Column], until: str) -> DataFrame:
    """Each row with the ``values`` of the version that was valid at its time; defaults where there was none.

    Versions are laid out by day up to ``until``, with the few that were valid
    in a day in one list, so that a row meets its key and day by an equal join
    and looks through that list; hot keys are salted.  ``matched`` says whether a version was found.
    """
    day = F.explode(F.sequence(F.to_date("valid_from"), F.least(F.coalesce(F.to_date("valid_to"), F.to_date(F.lit(until))), F.to_date(F.lit(until)))))
    cells = live.where(F.to_date("valid_from") <= F.to_date(F.lit(until))).select(*keys, "valid_from", "valid_to", *values, day.alias("_day"))
    cells = cells.groupBy(*keys, "_day").agg(F.collect_list(F.struct("valid_from", "valid_to", *values)).alias("_live"))  # one day's versions of a key
    met = salted_lookup(rows.withColumn("_day", F.to_date(at)), cells, [*keys, "_day"], salts=16)
    valid = lambda v: (v["valid_from"] <= F.col(at)) & (v["valid_to"].isNull() | (F.col(at) < v["valid_to"]))
    met = met.withColumn("_v", F.get(F.filter("_live", valid), F.lit(0)))
    return met.withColumn("matched", F.col("_v").isNotNull()).withColumns({v: F.coalesce(F.col("_v")[v], defaults[v]) for v in values}).drop("_v", "_live", "_day")
