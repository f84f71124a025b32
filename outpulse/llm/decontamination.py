"""Benchmark decontamination by winnowing, in Spark expressions only.

Of the k-gram hashes in each sliding window of w grams the least is kept, the
leftmost of equal ones.  Two texts that share k + w - 1 words share such a
window, and so a kept gram at the same place of it: joining the kept grams and
extending each hit word by word finds every shared span of that length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.llm.common import saved

SPAN = 10  # words of a shared span
GRAM = 5
FEW = 500_000  # kept grams of a benchmark that are sent to every executor, 200 bytes each at most
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLACE = (1 << 32) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where an inner function reads it for every element."""
    return F.transform(F.array(value), body)[0]


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a whole text (null: none)."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.transform(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def winnowed(hashes: Column, span: int) -> Column:
    """The kept grams of a text for shared spans of ``span`` words.

    Each has its ``span``, ``gram`` (hash) and place ``at`` (from 0), and the words
    of all spans that contain it, as far as the text goes: ``before`` it, nearest
    first, and ``after``, with its own.
    """
    k = min(GRAM, span)
    w = span - k + 1
    gram = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])
    # Half of a gram's hash above its place: the least of a window says where it is.
    keyed = F.transform(F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.shiftleft(gram(i), 32).bitwiseOR(i.cast("long")))
    least = let(keyed, lambda g: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(g) - (w - 1)), lambda s: F.array_min(F.slice(g, s, w)))))

    def described(at: Column) -> Column:
        first = F.greatest(at - (w - 1), F.lit(0))
        before = F.reverse(F.slice(hashes, first + 1, at - first))
        return F.struct(F.lit(span).alias("span"), gram(at).alias("gram"), at.alias("at"), before.alias("before"), F.slice(hashes, at + 1, span).alias("after"))

    none = F.array().cast("array<struct<span:int,gram:bigint,at:int,before:array<bigint>,after:array<bigint>>>")
    kept = F.transform(F.transform(least, lambda v: v.bitwiseAND(PLACE).cast("int")), described)
    return F.when(F.size(hashes) < span, none).otherwise(kept)


def run(left: str, right: str) -> Column:
    """How many of the first words of two arrays are equal."""
    same = F.zip_with(left, right, lambda x, y: x.eqNullSafe(y))
    stop = F.array_position(same, False).cast("int")
    return F.when(stop == 0, F.size(same)).otherwise(stop - 1)


def benchmark_grams(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Kept grams of all items, ``item_id`` and ``mark`` (a hash of gram and words) among their columns, and the spans there are.

    An item of fewer words than SPAN is one span of its own length, so there are at most SPAN lengths.
    """
    items = saved(benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_hashes(F.col("text")).alias("h")).where(F.size("h") > 0).distinct())
    spans = sorted(r[0] for r in items.select(F.least(F.size("h"), F.lit(SPAN)).alias("n")).distinct().collect())
    of_span = lambda n: items.where(F.size("h") >= n if n == SPAN else F.size("h") == n)
    parts = [of_span(n).select("item_id", F.explode(winnowed(F.col("h"), n)).alias("g")) for n in spans or [SPAN]]
    grams = reduce(DataFrame.unionByName, parts).select("item_id", "g.span", "g.gram", "g.before", "g.after")
    return saved(grams.withColumn("mark", F.xxhash64("span", "gram", "before", "after")).distinct()), spans


def looked_up(rows: DataFrame, grams: DataFrame, keys: list[str], how: str, salt: Column, few: bool) -> DataFrame:
    """Rows with the benchmark's grams: by broadcast where they are counted to be few, else by shuffle with every gram repeated per salt."""
    if few:
        return rows.join(F.broadcast(grams), keys, how)
    salted = grams.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"], how).drop("_salt")


def spans_hit(docs: DataFrame, grams: DataFrame, spans: list[int], few: bool) -> DataFrame:
    """``row``, ``doc_id``, ``n_words``, ``start``, ``end``, ``mark`` of each shared span, and one line with ``start`` -1 per row.

    The line of the row itself leaves among its grams, under a key of its own,
    so that an outer join keeps rows without hits and no key is hot.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), word_hashes(F.col("text")).alias("h"))
    words = F.array().cast("array<bigint>")
    own = F.struct(F.lit(0).alias("span"), F.xxhash64("row").alias("gram"), F.lit(-1).alias("at"), words.alias("before"), words.alias("after"))
    kept = F.concat(F.array(own), *[winnowed(F.col("h"), n) for n in spans])
    lined = rows.select("row", "doc_id", F.size("h").cast("long").alias("n_words"), F.explode(kept).alias("g"))
    lined = lined.select("row", "doc_id", "n_words", "g.span", "g.gram", "g.at", F.col("g.before").alias("d_before"), F.col("g.after").alias("d_after"))
    distinct = grams.select("span", "gram", "before", "after", "mark").distinct()
    met = looked_up(lined, distinct, ["span", "gram"], "left", F.xxhash64("row", "at"), few)
    met = met.where("at = -1 OR mark IS NOT NULL")
    met = met.withColumn("left", F.when(F.col("at") >= 0, run("d_before", "before"))).withColumn("right", F.when(F.col("at") >= 0, run("d_after", "after")))
    met = met.where((F.col("at") == -1) | (F.col("left") + F.col("right") >= F.col("span")))
    return met.select("row", "doc_id", "n_words", F.coalesce(F.col("at") - F.col("left"), F.lit(-1)).alias("start"), F.coalesce(F.col("at") + F.col("right"), F.lit(-1)).alias("end"), "mark")


def scan(docs: DataFrame, benchmark: DataFrame, few: int = FEW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` per row.

    A word is hit if it lies in an occurrence of SPAN consecutive words of an
    item, or of a whole item of fewer words.  Texts are read once and are not
    shuffled; only rows' own lines and hits are.  Null and empty texts have no
    words and no hits; a null id is an id; repeated rows each count; texts of any
    length are read whole; items without words or id name nothing, but those
    without id still hit words; empty tables give no row or no hit; other
    columns are ignored.  Words are compared by 64-bit hashes.
    """
    grams, spans = benchmark_grams(benchmark)
    is_few = grams.count() <= few
    met = saved(spans_hit(docs, grams, spans, is_few))
    by_start = Window.partitionBy("row").orderBy("start", "end")
    so_far = F.greatest(F.coalesce(F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(0))
    fresh = F.greatest(F.col("end") - F.greatest("start", so_far), F.lit(0))
    spread = met.select("row", "doc_id", "n_words", "start", "end").distinct().withColumn("fresh", fresh)
    rows = spread.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("fresh").cast("long").alias("n_hit"))
    marks = met.where("start >= 0").select("row", "mark").distinct()
    named = looked_up(marks, grams.where("item_id IS NOT NULL").select("mark", "item_id").distinct(), ["mark"], "inner", F.xxhash64("row"), is_few).select("row", "item_id").distinct()
    items = named.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("ids"))
    return rows.join(items, "row", "left").select(
        "doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
