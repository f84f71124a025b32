"""Nearest-in-time and fuzzy matching without pairing rows of a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outpulse.functions.text import similarity
from outpulse.operators.ordered import sliced
from outpulse.operators.ranking import first_per_key
from outpulse.session import stabilise


def nearest_in_time(
    left: DataFrame, right: DataFrame, keys: list[str], left_id: str, left_at: str, right_at: str, right_id: str,
    before: str | None = None, after: str | None = None, parts: int | None = None,
) -> DataFrame:
    """For each left row the right row of the same key nearest in time.

    Both sides are laid on one timeline per key and cut into slices of about
    equal rows (``sliced``).  Inside a slice the neighbours are running last/first
    values; across slices only the first and last right row of every slice
    travel.  A key and day with a third of all rows is therefore several sorts,
    and no pair is ever emitted.  ``before``/``after`` are intervals that bound how
    far the match may lie.  Of equally near rows the earlier one, then the
    smaller id, wins.  Right columns come back in the struct ``match``.
    """
    cols = [c for c in right.columns if c not in (*keys, right_at, right_id)]
    payload = F.struct(F.col(right_at).alias("at"), F.col(right_id).alias("id"), *cols)
    unique = first_per_key(right.dropna("any", subset=[*keys, right_at]), [*keys, right_at], [F.col(right_id)])
    r = unique.select(*keys, F.col(right_at).alias("_t"), F.lit(None).cast(left.schema[left_id].dataType).alias(left_id), payload.alias("_r"))
    l = left.dropna("any", subset=[*keys, left_at]).select(
        *keys, F.col(left_at).alias("_t"), left_id, F.lit(None).cast(r.schema["_r"].dataType).alias("_r")
    )
    inside = Window.partitionBy(*keys, "_c").orderBy("_t")
    back = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # The same running frame on the reversed order: a frame that ends unbounded is recomputed for every row.
    ahead = Window.partitionBy(*keys, "_c").orderBy(F.col("_t").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    line = sliced(l.unionByName(r), keys, ["_t", left_id], parts)
    near = line.select(
        *keys, "_c", "_t", left_id,
        F.last("_r", ignorenulls=True).over(back).alias("_p"), F.last("_r", ignorenulls=True).over(ahead).alias("_n"),
    ).where(F.col(left_id).isNotNull())
    ends = line.groupBy(*keys, "_c").agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"))
    over_slices = Window.partitionBy(*keys).orderBy("_c")  # one row per slice
    carry = ends.select(
        *keys, "_c",
        F.last("_hi", ignorenulls=True).over(over_slices.rowsBetween(Window.unboundedPreceding, -1)).alias("_cp"),
        F.last("_lo", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.col("_c").desc()).rowsBetween(Window.unboundedPreceding, -1)).alias("_cn"),
    )
    both = near.join(carry, [*keys, "_c"], "left")
    prev, nxt = F.coalesce("_p", "_cp"), F.coalesce("_n", "_cn")
    if before:
        prev = F.when(prev["at"] >= F.col("_t") - F.expr(f"interval {before}"), prev)
    if after:
        nxt = F.when(nxt["at"] <= F.col("_t") + F.expr(f"interval {after}"), nxt)
    both = both.select(left_id, "_t", prev.alias("_p"), nxt.alias("_n"))
    to_prev = F.col("_t") - F.col("_p.at")
    to_next = F.col("_n.at") - F.col("_t")
    pick = F.when(F.col("_n").isNull() | (to_prev <= to_next), F.coalesce("_p", "_n")).otherwise(F.col("_n"))
    return both.select(left_id, pick.alias("match")).where(F.col("match").isNotNull())


def first_available(parts: list[tuple[str, DataFrame]], id_col: str) -> DataFrame:
    """Keep the match of the first list entry that has one, per id."""
    out = None
    for order, (label, df) in enumerate(parts):
        d = df.select(id_col, F.lit(order).alias("_o"), F.lit(label).alias("matched_by"), "match")
        out = d if out is None else out.unionByName(d)
    return first_per_key(out, [id_col], [F.col("_o")]).drop("_o")


def shared_ends(names: DataFrame, c: str) -> tuple[int, int]:
    """Characters that all names begin and end with; one row is read.

    Edit distance does not change when both names lose a common beginning or end.
    """

    def common(x: str, y: str) -> int:
        return next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))

    back = F.reverse(c)
    low, high, last, first, short = names.agg(F.min(c), F.max(c), F.min(back), F.max(back), F.min(F.length(c))).first()
    if low is None:
        return 0, 0
    head = min(common(low, high), short)
    return head, min(common(last, first), short - head)


def segment_pairs(left: DataFrame, right: DataFrame, edits: int) -> DataFrame:
    """The pairs (``_l``, ``_m``) of names whose ``_x`` and ``_y`` are within ``edits`` edits."""
    return segment_candidates(left, right, edits).where(F.levenshtein("_x", "_y", edits) >= 0).select("_l", "_m").distinct()


def segment_candidates(left: DataFrame, right: DataFrame, edits: int, salts: int = 8) -> DataFrame:
    """Rows of two names that share a segment; no pair within ``edits`` edits is missing.

    The right string (``_y``) is cut into ``edits`` + 1 even segments; that many
    edits leave one of them whole, in the left one (``_x``) moved by what lengths
    and edits before and behind it allow.  Length, segment and place are part of
    the key, so only rows that agree in all three meet.  A segment that many names have is
    met in parts.
    """
    n = edits + 1
    place = lambda size, i: F.floor(size * i / n).cast("int")  # noqa: E731  start of segment i, from 0
    segment = F.explode(F.sequence(F.lit(0), F.lit(edits))).alias("i")
    cut = right.withColumn("b", F.length("_y")).select("_m", "_y", "b", segment, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    cut = cut.withColumn("at", place(F.col("b"), F.col("i"))).withColumn("part", F.substring("_y", F.col("at") + 1, place(F.col("b"), F.col("i") + 1) - F.col("at")))
    cut = cut.select("_m", "_y", "b", "i", "salt", "part")

    a = F.length("_x")
    seen = left.select("_l", "_x", F.explode(F.sequence(F.greatest(a - edits, F.lit(0)), a + edits)).alias("b")).select("_l", "_x", "b", segment)
    seen = seen.withColumn("at", place(F.col("b"), F.col("i"))).withColumn("size", place(F.col("b"), F.col("i") + 1) - F.col("at"))
    # Before segment i at most i edits, behind it at most edits - i: so far may it have moved.
    moved = F.length("_x") - F.col("b")
    low = F.greatest(F.col("at") - F.col("i"), F.col("at") + moved - (edits - F.col("i")), F.lit(0))
    high = F.least(F.col("at") + F.col("i"), F.col("at") + moved + (edits - F.col("i")), F.length("_x") - F.col("size"))
    seen = seen.withColumn("low", low).withColumn("high", high).where("low <= high").withColumn("s", F.explode(F.sequence("low", "high")))
    seen = seen.select("_l", "_x", "b", "i", F.pmod(F.xxhash64("_l"), F.lit(salts)).cast("int").alias("salt"), F.substring("_x", F.col("s") + 1, F.col("size")).alias("part")).distinct()
    return seen.join(cut, ["b", "i", "salt", "part"])


def best_similar(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, minimum: float = 0.8
) -> DataFrame:
    """Closest right name per left name with similarity >= ``minimum``.

    Equal names are settled by an ordinary join.  The others are met edit by
    edit: at one edit names are cut into two long segments, at two into three,
    and so on (``segment_pairs``), and a left name takes part only while a pair
    of so many edits could beat or tie what it has.  So near-equal names meet
    through long segments first and most never come to the short, frequent ones.
    What all names begin and end with is left away.
    """
    l = left.select(F.col(left_name).alias("_l")).where("_l <> ''").distinct()
    r = right.select(F.col(right_name).alias("_m")).where("_m <> ''").distinct()
    found = l.join(r, F.col("_l") == F.col("_m")).select("_l", "_m", F.lit(1.0).alias("score"))
    rest = l.join(r, F.col("_l") == F.col("_m"), "left_anti")
    head, tail = shared_ends(rest.select("_l").unionByName(r.select(F.col("_m").alias("_l"))), "_l")
    middle = lambda c: F.substring(F.col(c), F.lit(head + 1), F.length(c) - (head + tail))
    open_names = stabilise(rest.select("_l", middle("_l").alias("_x"), F.lit(-1.0).alias("score"), F.lit(None).cast("string").alias("_m")))
    names = stabilise(r.select("_m", middle("_m").alias("_y")))
    a, edits = F.length("_l"), 0
    while True:
        edits += 1
        # The likeness of a pair of so many edits is the greatest where the right name is that much longer.
        could = 1 - edits / (a + edits).cast("double")
        in_play = open_names.where((could >= F.greatest("score", F.lit(minimum)) - 1e-9))
        if in_play.isEmpty():
            break
        pairs = segment_pairs(in_play.select("_l", "_x"), names, edits).withColumn("score", similarity("_l", "_m")).where(F.col("score") >= minimum)
        better = first_per_key(pairs.unionByName(open_names.where("_m IS NOT NULL").select("_l", "_m", "score")), ["_l"], [F.col("score").desc(), F.col("_m")])
        open_names = stabilise(open_names.select("_l", "_x").join(better, "_l", "left").select("_l", "_x", F.coalesce("score", F.lit(-1.0)).alias("score"), "_m"))
    found = found.unionByName(open_names.where("_m IS NOT NULL").select("_l", "_m", "score"))
    return found.select(F.col("_l").alias(left_name), F.col("_m").alias(right_name), "score")
