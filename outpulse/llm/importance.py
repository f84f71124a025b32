"""Importance resampling towards a target by hashed n-grams, each distinct line counted once.

A line end is no word character, so every run of words lies within a line or
crosses line ends.  Runs within are counted once per distinct line and
multiplied by its occurrences; runs that cross are counted per document.
"""

from __future__ import annotations

import re
import zlib
from hashlib import md5

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.llm.common import WORD, by_batch, by_task, saved, stored
from outpulse.operators.ranking import numbered

BUCKETS = 10_000
HOT = 2_000  # lines with at least 1 / HOT of all occurrences; there can be no more of them
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def line_features(found: list[bytes]) -> list[int]:
    """Buckets of all runs of one to three of these words; a word's checksum goes on with the next word."""
    out = []
    one = two = None  # checksums of the runs of one and two words that end here
    crc = zlib.crc32
    for w in found:
        spaced = b" " + w
        three = crc(spaced, two) if two is not None else None
        two = crc(spaced, one) if one is not None else None
        one = crc(w)
        out.append(one % BUCKETS)
        if two is not None:
            out.append(two % BUCKETS)
            if three is not None:
                out.append(three % BUCKETS)
    return out


def crossing_features(lines: list[list[str]]) -> list[int]:
    """Buckets of the runs of two and three words that cross a line end; lines without words are left out before."""
    out, before = [], []  # the last two words so far
    for n, line in enumerate(lines):
        if before:
            for start in range(len(before)):
                for end in range(1, min(3 - (len(before) - start), len(line)) + 1):
                    out.append(zlib.crc32(" ".join(before[start:] + line[:end]).encode("utf-8", "surrogatepass")) % BUCKETS)
        before = line[-2:] if len(line) > 1 else (before + line)[-2:]
    return out


def key_of(line: str) -> bytes:
    return md5(line.encode("utf-8", "surrogatepass")).digest()


class Counted:
    """The feature counts of a corpus: rows, distinct lines with their buckets, and totals per bucket.

    ``rows``: ``row`` (unique), ``doc_id``, ``n_words``, ``n_features``, ``keys`` and ``times`` of its lines, ``crossing`` buckets.
    ``lines``: ``key``, ``n`` (occurrences), ``buckets`` (16-bit) of each distinct line that has words.
    """

    def __init__(self, docs: DataFrame, id_column: str):
        text = lower(F.col("text"))
        part = F.split(text, "\n")
        line = docs.select(F.explode(part).alias("line")).groupBy("line").agg(F.count("*").alias("n"))

        def features(batch):
            out = {"key": [], "n": [], "buckets": []}
            for found, n in zip(batch.column("line").to_pylist(), batch.column("n").to_pylist()):
                words = WORD.findall(found)
                if words:
                    out["key"].append(key_of(found))
                    out["n"].append(n)
                    out["buckets"].append(np.array(line_features([w.encode("utf-8", "surrogatepass") for w in words]), "<u2").tobytes())
            return out

        self.lines = stored(by_batch(line, "key binary, n long, buckets binary", features), "lines")

        def parts(batches):
            number = TaskContext.get().partitionId() << 40
            for batch in batches:
                out = {c: [] for c in ("row", "doc_id", "n_words", "n_features", "keys", "times", "crossing")}
                for doc_id, whole in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    times, with_words = {}, []
                    for found in whole.split("\n"):
                        words = WORD.findall(found)
                        if words:
                            times[found] = times.get(found, 0) + 1
                            with_words.append(words)
                    n = sum(map(len, with_words))
                    crossing = crossing_features(with_words)
                    for name, value in zip(out, (number, doc_id, n, n + max(n - 1, 0) + max(n - 2, 0), [key_of(x) for x in times], list(times.values()), crossing)):
                        out[name].append(value)
                    number += 1
                yield out

        plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
        self.rows = stored(by_task(plain, "row long, doc_id long, n_words long, n_features long, keys array<binary>, times array<long>, crossing array<int>", parts), "rows")

    def totals(self) -> np.ndarray:
        """How many features fall in each bucket; a task leaves at most BUCKETS sums."""

        def add(batches):
            sums = np.zeros(BUCKETS, np.int64)
            for batch in batches:
                for n, buckets in zip(batch.column("n").to_pylist(), batch.column("buckets").to_pylist()):
                    sums += n * np.bincount(np.frombuffer(buckets, "<u2"), minlength=BUCKETS) if len(buckets) > 4000 else 0
                    if len(buckets) <= 4000:
                        np.add.at(sums, np.frombuffer(buckets, "<u2"), n)
            met = np.flatnonzero(sums)
            yield {"bucket": met, "n": sums[met]}

        within = by_task(self.lines.select("n", "buckets"), "bucket int, n long", add)
        crossing = self.rows.select(F.explode("crossing").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
        out = np.zeros(BUCKETS, np.int64)
        for bucket, n in within.unionByName(crossing).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[bucket] = n
        return out


def gains(spark, source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS)))) of every bucket, in doubles."""
    ratio = (target + 1.0) * (float(source.sum()) + BUCKETS) / ((source + 1.0) * (float(target.sum()) + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(counted: Counted, gain: np.ndarray) -> DataFrame:
    """``row`` and ``weight``: the gains of all its features.

    A distinct line's gains are summed once.  Lines that make up 1 / HOT of all
    occurrences or more, at most HOT of them, are joined by broadcast, so that
    the shuffle of the others meets no hot key.
    """

    def summed(batch):
        return {"key": batch.column("key"), "n": batch.column("n"), "gain": [int(gain[np.frombuffer(b, "<u2")].sum()) for b in batch.column("buckets").to_pylist()]}

    def crossed(batch):
        column = batch.column("crossing")
        flat = np.concatenate([[0], np.cumsum(gain[column.flatten().to_numpy(zero_copy_only=False)])])
        ends = np.cumsum(np.concatenate([[0], column.value_lengths().to_numpy(zero_copy_only=False)]))
        return {"row": batch.column("row"), "gain": flat[ends[1:]] - flat[ends[:-1]]}

    of_line = saved(by_batch(counted.lines, "key binary, n long, gain long", summed))
    least = of_line.agg((F.sum("n") / HOT).alias("x")).first()[0] or 0
    hot = F.broadcast(of_line.where(F.col("n") >= least).select("key", F.col("gain").alias("hot")))
    met = counted.rows.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("row", F.col("x.keys").alias("key"), F.col("x.times").alias("times"))
    met = met.join(hot, "key", "left")
    add = lambda gain: (F.col(gain) * F.col("times")).alias("gain")
    frequent = met.where("hot IS NOT NULL").select("row", add("hot"))
    others = met.where("hot IS NULL").join(of_line.where(F.col("n") < least).select("key", "gain"), "key").select("row", add("gain"))
    across = by_batch(counted.rows.select("row", "crossing"), "row long, gain long", crossed)
    return frequent.unionByName(others).unionByName(across).groupBy("row").agg(F.sum("gain").alias("weight"))


def resample(docs: DataFrame, target: DataFrame, target_id: str = "item_id", percent: int = 5, least_words: int = 20, seed: str = "42:") -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null where not drawn) of every row.

    Gumbel noise from the id makes the highest scores a sample without
    replacement in proportion to exp(weight / 1000).  A null text has no words
    and weight 0; a null id has no noise, no score and is never drawn; repeated
    rows each count and each get a rank; rows of equal score go by id, then by
    features; texts of any length are read whole; empty tables give no row, and
    an empty target only the smoothing; other columns are ignored.
    """
    counted, wanted = Counted(docs, "doc_id"), Counted(target, target_id)
    gain = gains(docs.sparkSession, counted.totals(), wanted.totals())
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(seed), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = counted.rows.select("row", "doc_id", "n_words", "n_features").join(weights(counted, gain), "row", "left")
    scored = scored.withColumn("weight", F.coalesce("weight", F.lit(0).cast("long"))).withColumn("score", F.col("weight") + noise)
    scored = saved(scored.withColumn("may", F.col("score").isNotNull() & (F.col("n_words") >= least_words)))
    n = scored.where("may").count()
    wanted_rows = percent * n // 100
    # More than enough rows pass this cut: a percentile of accuracy 10,000 is off by 1 / 10,000 of the rows at most.
    low = max(0.0, 1 - percent / 100 - 0.002)
    cut = scored.where("may").agg(F.percentile_approx("score", low, 10_000)).first()[0]
    passed = F.col("may") & (F.col("score") >= F.lit(cut).cast("long"))
    passed = F.coalesce(passed, F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc(), F.col("row").asc()]
    ranked = numbered(scored.where(passed), order, "rank").withColumn("rank", F.when(F.col("rank") <= wanted_rows, F.col("rank")))
    rest = scored.where(~passed).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
