"""Top-k, latest-row and percentile ranks that never gather a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.session import stabilise


def top_k(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows per key.

    A literal bound on ``row_number`` lets Spark put a WindowGroupLimit before
    the shuffle, so each map task forwards at most ``k`` rows of any key.
    ``order`` must end in a unique column.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_k(df, keys, order, 1, "_first").drop("_first")


HOT_ROWS = 200_000  # distinct values, of some 50 bytes each, that one task may sort and every executor be sent


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL being a key like others; the right side's keys do not come along."""
    renamed = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, same, how).drop(*[f"_k{i}" for i in range(len(keys))])


def value_counts(df: DataFrame, keys: list[str], value: str, parts: int | None = None, descending: bool = False) -> DataFrame:
    """Each distinct value per key with its rows ``_c``, the rows before it ``_below`` and those of the key ``_n``.

    Equal values meet in a partial count, so a value that a third of all rows
    have is one row.  Up to HOT_ROWS of them are added up in a plain window.
    More are laid in one range sort of (key, value), narrow, and counted part by
    part; the totals of the parts, one row each, are the offsets.  A key with
    most of the values lies in many parts.  NULLs come first (last where
    ``descending``).
    """
    counts = stabilise(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")))
    return _added_up(counts, keys, value, parts, descending, counts.count() <= HOT_ROWS)


def _added_up(counts: DataFrame, keys: list[str], value: str, parts: int | None, descending: bool, few: bool) -> DataFrame:
    last = F.col(value).desc() if descending else F.col(value).asc()
    if few:
        group = Window.partitionBy(*(keys or [F.lit(0)]))
        below = F.sum("_c").over(group.orderBy(last).rowsBetween(Window.unboundedPreceding, -1))
        return counts.withColumn("_below", F.coalesce(below, F.lit(0))).withColumn("_n", F.sum("_c").over(group))
    parts = parts or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*[F.col(k).asc() for k in keys], last]
    placed = counts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stabilise(placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    sizes = placed.groupBy("_part").agg(F.sum("_c").alias("_size"))
    earlier = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row per part
    offsets = sizes.select("_part", F.coalesce(earlier, F.lit(0)).alias("_offset"))
    inside = F.sum("_c").over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    summed = placed.withColumn("_in", F.coalesce(inside, F.lit(0))).join(F.broadcast(offsets), "_part").withColumn("_below", F.col("_offset") + F.col("_in"))
    summed = summed.select(*keys, value, "_c", "_below")
    if not keys:
        return summed.withColumn("_n", F.coalesce(placed.agg(F.sum("_c")).scalar(), F.lit(0)))
    of_key = summed.groupBy(*keys).agg(F.min("_below").alias("_first"), F.sum("_c").alias("_n"))
    return null_safe(summed, of_key, keys).withColumn("_below", F.col("_below") - F.col("_first")).drop("_first")


def with_ranks(
    df: DataFrame,
    specs: list[tuple[str, list[str], str]],
    buckets: int | None = None,
    salts: int = 16,
    descending: bool = False,
    stable: bool = False,
) -> DataFrame:
    """Exact SQL RANK and group size for each ``(name, keys, value)``.

    Adds ``<name>_rank`` and ``<name>_n``.  What is sorted are the distinct values
    (``value_counts``, in ``buckets`` parts); the rows themselves look their rank
    up: by broadcast where the values are counted to be few, else by a join in
    which the rank of a value of more than HOT_ROWS rows, and of no other, is repeated
    for the ``salts`` of its rows.  No task therefore sorts or receives a key or a
    value that holds a large share of the rows.
    NULLs rank first.
    """
    out = df if stable else stabilise(df)
    hashed = [c for c, t in out.dtypes if not t.startswith("map")]
    for name, keys, value in specs:
        by = [*keys, value]
        counts = stabilise(out.groupBy(*by).agg(F.count(F.lit(1)).alias("_c")))
        often = F.col("_c") > HOT_ROWS
        size = counts.agg(F.count(F.lit(1)).alias("values"), F.count_if(often).alias("hot")).first()
        few = size["values"] <= HOT_ROWS
        ranks = _added_up(counts, keys, value, buckets, descending, few)
        numbers = [(F.col("_below") + 1).cast("long").alias(f"{name}_rank"), F.col("_n").alias(f"{name}_n")]
        if few:
            out = null_safe(out, F.broadcast(ranks.select(*by, *numbers)), by)
        elif not size["hot"]:
            out = null_safe(out, ranks.select(*by, *numbers), by)
        else:
            last = F.when(often, salts - 1).otherwise(0)
            repeated = ranks.select(*by, F.explode(F.sequence(F.lit(0), last)).alias("_salt"), *numbers)
            hot = counts.where(often).select(*by, F.lit(True).alias("_hot"))  # at most one in HOT_ROWS rows
            salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*hashed), F.lit(salts))).otherwise(0).cast("int")
            salted = null_safe(out, F.broadcast(hot), by, "left").withColumn("_salt", salt).drop("_hot")
            out = null_safe(salted, repeated, [*by, "_salt"]).drop("_salt")
    return out


def with_percent_ranks(
    df: DataFrame, specs: list[tuple[str, list[str], str]], **options
) -> DataFrame:
    """(rank - 1) / (n - 1) per spec, 0 for a group of one."""
    ranked = with_ranks(df, specs, **options)
    for name, _, _ in specs:
        ranked = ranked.withColumn(
            name,
            F.when(
                F.col(f"{name}_n") > 1,
                (F.col(f"{name}_rank") - 1) / (F.col(f"{name}_n") - 1).cast("double"),
            ).otherwise(F.lit(0.0)),
        ).drop(f"{name}_rank", f"{name}_n")
    return ranked


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds the row's number, from 1, in ``order``, which must end in a unique column.

    One range sort of the rows, written once so that every number stays where it
    is; the sizes of the sorted parts, one row each, give the offsets.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stabilise(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row per part
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    numbers = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbers.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_part", "_before")


def medians(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Exact median per key, NULL where a key has no value.

    The middle ranks are picked from the counted distinct values, so no task
    holds the values of a key, whatever share of the rows it has.
    """
    counts = value_counts(df.where(F.col(value).isNotNull()), keys, value)
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    end = F.col("_below") + F.col("_c")
    holds = lambda rank: (F.col("_below") <= rank) & (rank < end)
    middle = counts.where(holds(low) | holds(high))  # one value or two
    found = middle.groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias(name))
    return null_safe(df.select(*keys).distinct(), found, keys, "left") if keys else found
