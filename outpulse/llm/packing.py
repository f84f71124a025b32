"""Packing token counts into sequences: repeated length patterns fitted to the histogram."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outpulse.llm.common import by_batch, saved, texts
from outpulse.llm.tokens_file import END, library

COARSE = 1024  # length classes of the fitted patterns
DEPTH = 4  # documents of a fitted pattern at most; more join when room is left
REST = 2  # classes that a fitted pattern may leave empty
PATTERNS = 300  # rounds of the fit, each of which adds one pattern at most


def active_set(b: np.ndarray, steepest: Callable[[np.ndarray], tuple], rounds: int) -> dict:
    """The columns, by key, with x > 0 where ``|ax - b|`` is least for x >= 0, by Lawson and Hanson.

    ``steepest`` gives, for a residual, the key, the column and the gradient of
    the steepest column (key None: all are flat), so they need not be listed.
    """
    keys, a, x = [], np.zeros((len(b), 0)), np.zeros(0)
    for _ in range(rounds):
        key, column, _ = steepest(b - a @ x)
        if key is None or key in keys:
            break
        keys, a, x = [*keys, key], np.column_stack([a, column]), np.append(x, 0)
        while True:
            try:
                s = np.linalg.solve(a.T @ a, a.T @ b)
            except np.linalg.LinAlgError:
                s = np.linalg.lstsq(a, b, rcond=None)[0]
            low = s <= 0
            if not low.any():
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x += step * (s - x)
            stay = x > 1e-12
            keys, a, x = [k for k, held in zip(keys, stay) if held], a[:, stay], x[stay]
        x = s
    return dict(zip(keys, x))


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with least ``|ax - b|``."""

    def steepest(residual):
        gradient = a.T @ residual
        flat = not len(gradient) or gradient.max() <= 1e-9 * max(1.0, np.abs(b).max())
        j = None if flat else int(gradient.argmax())
        return j, None if flat else a[:, j], None if flat else gradient[j]

    x = np.zeros(a.shape[1])
    for j, value in active_set(b, steepest, rounds).items():
        x[j] = value
    return x


def fitted(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of up to DEPTH classes that fill a sequence but for REST classes, with their least-squares repeats.

    ``counts`` has the documents of the classes 1, 2, ...; a sequence holds as
    many classes as there are.  All patterns of present classes take part: the
    steepest one is composed of two best halves per sum, not looked up in a list.
    """
    most = len(counts)
    sums = np.arange(most + 1)
    other = sums[None, :] - sums[:, None]
    inside = other >= 0
    other = np.where(inside, other, 0)

    def steepest(residual):
        one = np.where(counts > 0, residual, -np.inf)
        one = np.append(0.0, one)  # class 0: no document
        halves = np.where(inside, one[:, None] + one[other], -np.inf)
        first = halves.argmax(0)
        two = halves[first, sums]
        best = (1.0, None)  # less than a document is not worth a pattern
        for total in range(max(1, most - REST), most + 1):
            whole = two[: total + 1] + two[total::-1]
            at = int(whole.argmax())
            if whole[at] >= best[0]:
                best = (whole[at], tuple(sorted(int(k) for h in (at, total - at) for k in (first[h], h - first[h]) if k)))
        gradient, pattern = best
        return pattern, pattern and np.bincount(pattern, minlength=most + 1)[1:].astype(float), gradient

    return [(p, int(n + 1e-6)) for p, n in sorted(active_set(counts, steepest, PATTERNS).items(), key=lambda x: -x[1])]


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used; together they use up the histogram.

    Patterns of up to DEPTH length classes that about fill a sequence have
    their repeat counts fitted to the histogram by non-negative least squares
    and rounded down.  What is left, and the room that rounding to classes left
    in the patterns, is filled best-fit, largest first, on counts: the work
    depends on ``size`` and the number of different lengths, not on how many
    documents there are.
    """
    histogram = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= size for n in histogram):
        raise ValueError("a length is outside of 1 and the size of a sequence")
    unit = -(-size // COARSE)
    counts = np.zeros(size // unit)
    for n, c in histogram.items():
        if -(-n // unit) <= len(counts):
            counts[-(-n // unit) - 1] += c
    return filled(histogram, size, unit, fitted(counts))


def filled(histogram: dict[int, int], size: int, unit: int, patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[tuple[int, ...], int]]:
    """The plan that starts with ``patterns`` of length classes, ``unit`` lengths each."""
    left = dict(histogram)
    of_class: dict[int, list[int]] = defaultdict(list)
    for n in sorted(left):
        of_class[-(-n // unit)].append(n)
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def take(k: int, n: int) -> list[tuple[int, int]]:
        runs = []
        while n and of_class[k]:
            length = of_class[k][-1]
            m = min(n, left[length])
            runs.append((length, m))
            left[length] -= m
            n -= m
            if not left[length]:
                del left[length]
                of_class[k].pop()
        return runs

    for p, n in patterns:
        n = int(min(n, *(sum(left[x] for x in of_class[k]) // p.count(k) for k in p)))
        if n <= 0:
            continue
        columns = [take(k, n) for k in p]
        at = [0] * len(p)
        used = [0] * len(p)
        done = 0
        while done < n:  # runs of equal lengths side by side
            m = min(columns[i][at[i]][1] - used[i] for i in range(len(p)))
            lengths = tuple(columns[i][at[i]][0] for i in range(len(p)))
            rooms[size - sum(lengths)].append((lengths, m))
            done += m
            for i in range(len(p)):
                used[i] += m
                if used[i] == columns[i][at[i]][1]:
                    at[i], used[i] = at[i] + 1, 0
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = next((r for r in range(length, size) if rooms.get(r)), size)
            each = min(room // length, n)  # copies that one sequence takes before the next is looked at
            lengths, m = rooms[room].pop() if room < size else ((), n // each)
            k = min(m, n // each)
            if m > k:
                rooms[room].append((lengths, m - k))
            n -= k * each
            rooms[room - each * length].append((lengths + (length,) * each, k))
    total: dict[tuple[int, ...], int] = defaultdict(int)
    for found in rooms.values():
        for lengths, n in found:
            total[lengths] += n
    return sorted(total.items())


def token_pieces(docs: DataFrame, tokenizer: str, size: int, keeps_space: bool = False) -> DataFrame:
    """Each document's ids with the end id 0, cut only where longer than ``size``: a row per piece."""

    def work(batch):
        out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), library(tokenizer, keeps_space).encode(batch.column("text").to_pylist())):
            ids += END
            for piece, at in enumerate(range(0, len(ids), 4 * size)):
                part = ids[at : at + 4 * size]
                for name, value in (("doc_id", doc_id), ("piece", piece), ("start", at // 4), ("length", len(part) // 4), ("ids_crc32", zlib.crc32(part))):
                    out[name].append(value)
        return out

    return by_batch(texts(docs), "doc_id long, piece int, start long, length long, ids_crc32 long", work)


def assign(pieces: DataFrame, size: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length``; sequences are gapless from 0.

    Only the histogram of lengths (``size`` counts at most) reaches the driver.
    A piece is numbered among those of its length by its task's share and its
    place there, so a length that a third of all pieces have is no one task's.
    """
    pieces = saved(pieces.withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    shares = saved(pieces.groupBy("length", "_task").agg(F.count("*").alias("n")))
    histogram = {r.length: r.n for r in shares.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # per length: from which rank on a pattern's slot takes its pieces, its first sequence and its offset
    slots, ranks, sequence = [], defaultdict(int), 0
    for lengths, n in plan(histogram, size):
        offset = 0
        for length in lengths:
            slots.append((length, ranks[length], sequence, offset))
            ranks[length] += n
            offset += length
        sequence += n
    keys = np.array(sorted(slots) or np.zeros((0, 4)), np.int64)
    # a slot's key is its length and first rank; the search stays inside the length
    found = pieces.sparkSession.sparkContext.broadcast((keys[:, 0] * float(1 << 42) + keys[:, 1], keys))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = shares.select("length", "_task", before.alias("base"))
    # the rows of a task in their order; a task's rows of one length are its bounded share
    ranked = pieces.join(bases, ["length", "_task"]).withColumn("rank", F.col("base") + F.row_number().over(Window.partitionBy("_task", "length").orderBy("_row")) - 1)

    def work(batch):
        cuts, table = found.value
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        at = np.searchsorted(cuts, length * float(1 << 42) + rank, side="right") - 1
        same = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
        return same | {"sequence_id": table[at, 2] + rank - table[at, 1], "offset": table[at, 3]}

    return by_batch(
        ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", work,
    )


def pack(docs: DataFrame, tokenizer: str, size: int = 2048) -> DataFrame:
    """Packs all documents: a row per piece with its sequence and its place there.

    A null or empty text is its end id alone; repeated rows and ids are packed
    as often as they occur; an empty table gives no row; columns other than
    doc_id and text are ignored.
    """
    return assign(token_pieces(docs, tokenizer, size), size)
