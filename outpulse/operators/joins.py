"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of a plan (an upper bound for scans,
    projections and aggregates; nothing is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").lower()
    limit = int("".join(ch for ch in text if ch.isdigit() or ch == "-") or -1)
    for unit, power in (("k", 10), ("m", 20), ("g", 30)):
        if unit in text:
            limit <<= power
    return 0 <= estimated_bytes(df) <= limit


def salted_lookup(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", salts: int | None = None
) -> DataFrame:
    """Join many rows to at most one row per key.

    By default a plain join: adaptive execution measures the shuffled
    partitions and splits those that one key has made too large, repeating only
    the matching right partition (``build_session`` sets it to do so even where
    a later operator then needs another shuffle).  With ``salts`` every left row takes
    a salt from its own content and the right side is repeated once per salt,
    for keys known to be hot.  The salt is a hash of the row, never ``rand()``: a
    task that runs again after a lost executor sends its rows to the same place.
    """
    if salts is None or salts <= 1 or fits_broadcast(right):
        return left.join(right, keys, how)
    hashed = [c for c, t in left.dtypes if not t.startswith("map")]
    l = left.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
    r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return l.join(r, [*keys, "_salt"], how).drop("_salt")


def packed_lookup(
    left: DataFrame, right: DataFrame, by: list[str], within: list[str], grid: dict[str, Column] | None = None
) -> DataFrame:
    """Left join on ``by`` and ``within`` to a side that has few rows per ``by`` (an account's hours or days).

    They travel as one map per ``by``, so several lookups of one account find the
    left rows where the first has dealt them.  As many rows come out as of a plain
    join: keys may repeat on both sides, a NULL key finds nothing.  ``grid`` names
    arrays whose entries become left rows after the shuffle, not before it.
    """
    types = {**dict(left.dtypes), **{c: t[6:-1] for c, t in left.limit(0).select(*[a.alias(c) for c, a in (grid or {}).items()]).dtypes}}
    values = [c for c in right.columns if c not in (*by, *within)]

    def key() -> Column:
        return F.struct(*within) if len(within) > 1 else F.col(within[0])

    known = right.dropna("any", subset=[*by, *within]).withColumns({c: F.col(c).cast(types[c]) for c in within})
    known = known.groupBy(*by, *within).agg(F.collect_list(F.struct(*values)).alias("_rows")).groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct(key().alias("_key"), "_rows"))).alias("_known"))
    out = left.join(known, by, "left")
    for name, entries in (grid or {}).items():
        out = out.withColumn(name, F.explode(entries))
    cols = [c for c in out.columns if c != "_known"]
    found = out.select(*cols, F.explode_outer(F.try_element_at("_known", key())).alias("_row"))
    return found.select(*cols, *[F.col("_row")[c].alias(c) for c in values])


def group_stats(df: DataFrame, keys: list[str], **aggregates) -> DataFrame:
    """Attach whole-group aggregates without a whole-group window: partial
    aggregation first, then a salted lookup."""
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return salted_lookup(df, stats, keys)


def overall(df: DataFrame, **aggregates) -> dict:
    """One-row aggregates as parts of a single scalar subquery, usable inside
    any expression.  One struct means one pass: equal subqueries are reused."""
    row = df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("s")).scalar()
    return {n: row.getField(n) for n in aggregates}


def absent_from(df: DataFrame, *lookups: tuple[DataFrame, list[str]]) -> DataFrame:
    """Rows whose key is in none of the lookups: one hash anti join per key
    instead of one OR condition (which would plan as a nested loop)."""
    for other, keys in lookups:
        df = df.join(other.select(*keys).distinct(), keys, "left_anti")
    return df
