"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Two versions' sketches are subtracted cell by cell; peeling the cells that hold
one digest recovers what differs.  Where it fails, both are built larger.

A published fingerprint is one such sketch of all digests, large enough to be
peeled alone, so that two of them can be compared without their texts.  Its size
is a power of two, so folding it in half gives the sketch of half the size: two
are folded to the smaller one's size, subtracted and peeled; where that is too
small for what differs, each is peeled alone.  The likeness is always exact.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpulse.llm.common import by_task, chunk_bounds, partitions, texts, with_chunk

WORDS = 4  # of a sentence or line per paragraph cell
FIRST = 4  # cells in each of the three parts of the smallest sketch
GROWTH = 4
FULL = 2.4  # digests for each cell of a part beyond which a sketch can hardly be peeled alone
CELLS = 1 << 20  # cells compared at once, or one pair
CELL = np.dtype([("key", "<u8"), ("check", "<u4"), ("count", "<i4")])
SENTENCES = re.compile(r"(?<=[.!?]) |\n")
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

SALTS = (A, A + np.uint64(1), A + np.uint64(2))  # of the three cells of a digest


def paragraphs(text: str) -> list[str]:
    """Lines cut after sentence ends and then every WORDS words; empty ones are left out."""
    out = []
    for sentence in SENTENCES.split(text):
        w = sentence.split(" ")
        out += [sentence] if len(w) <= WORDS else [" ".join(w[i : i + WORDS]) for i in range(0, len(w), WORDS)]
    return [p for p in out if p]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * B
    x = (x ^ (x >> np.uint64(29))) * A
    return x ^ (x >> np.uint64(32))


def checked(key: np.ndarray) -> np.ndarray:
    return mixed(key ^ B) >> np.uint64(32)


def in_row(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One number for row and digest together."""
    return mixed(key + row.astype(np.uint64) * B)


class Digests:
    """Paragraph digests of many texts side by side; the k-th repeat of a paragraph has a digest of its own."""

    def __init__(self, many: list[str]):
        parts = [[xxhash.xxh64_intdigest(p) for p in paragraphs(t)] for t in many]
        self.count = np.array([len(p) for p in parts], np.int64)
        self.row = np.repeat(np.arange(len(many)), self.count)
        keys = np.array([k for p in parts for k in p], np.uint64)
        both = in_row(self.row, keys)
        order = np.argsort(both)
        both = both[order]
        fresh = np.ones(len(both), bool)
        fresh[1:] = both[1:] != both[:-1]
        at = np.arange(len(both))
        repeat = at - np.maximum.accumulate(np.where(fresh, at, 0)) if len(both) else at
        self.key = np.empty_like(keys)
        self.key[order] = mixed(keys[order] + repeat.astype(np.uint64) * A)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``rows`` (increasing numbers of texts) and digests of the chosen texts."""
        place = np.full(len(self.count), -1)
        place[rows] = np.arange(len(rows))
        at = place[self.row]
        return at[at >= 0], self.key[at >= 0]


class Sketches:
    """One sketch per row: counts, and xors of digests and of their check hashes; 3 * part cells each."""

    def __init__(self, rows: int, part: int):
        self.part, self.width = part, 3 * part
        self.count = np.zeros(rows * self.width, np.int64)
        self.key = np.zeros(rows * self.width, np.uint64)
        self.check = np.zeros(rows * self.width, np.uint64)

    def some(self, rows: np.ndarray) -> Sketches:
        """A copy of these rows."""
        out = Sketches(0, self.part)
        out.count, out.key, out.check = (x.reshape(-1, self.width)[rows].ravel() for x in (self.count, self.key, self.check))
        return out

    def add(self, row: np.ndarray, key: np.ndarray, sign: np.ndarray | int) -> None:
        check = checked(key)
        for k in range(3):
            at = row * self.width + k * self.part + (mixed(key + SALTS[k]) % np.uint64(self.part)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, key)
            np.bitwise_xor.at(self.check, at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, digests and signs recovered; where cells are left the sketch was too small (``failed``)."""
        found = []
        look = np.flatnonzero(self.count)
        for _ in range(self.width):  # a chance hit of the check could come and go for ever
            pure = look[(np.abs(self.count[look]) == 1) & (checked(self.key[look]) == self.check[look])]
            if not len(pure):
                break
            row, key, sign = pure // self.width, self.key[pure], self.count[pure]
            _, first = np.unique(in_row(row, key), return_index=True)
            row, key, sign = row[first], key[first], sign[first]
            found.append((row, key, sign))
            self.add(row, key, -sign)
            look = np.flatnonzero(self.count)
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (none, none.astype(np.uint64), none)

    def failed(self, rows: int) -> np.ndarray:
        return ((self.count != 0) | (self.key != 0)).reshape(rows, self.width).any(axis=1)


def differences(one: Digests, rows_one: np.ndarray, two: Digests, rows_two: np.ndarray) -> np.ndarray:
    """How many digests each pair of texts does not share, by subtracted and peeled sketches."""
    n = len(rows_one)
    out = np.zeros(n, np.int64)
    left = np.arange(n)
    part = FIRST
    least = np.abs(one.count[rows_one] - two.count[rows_two])
    while len(left):
        now = left[least[left] <= 2 * part]  # fewer cells cannot hold the difference
        if len(now):
            s = Sketches(len(now), part)
            s.add(*one.take(rows_one[now]), 1)
            s.add(*two.take(rows_two[now]), -1)
            row, _, _ = s.peel()
            bad = s.failed(len(now))
            out[now] = np.bincount(row, minlength=len(now))
            left = np.setdiff1d(left, now[~bad], assume_unique=True)
        part *= GROWTH
    return out


def likeness(one: Digests, rows_one: np.ndarray, two: Digests, rows_two: np.ndarray) -> np.ndarray:
    """Shared digests over all digests of each pair; two texts without any are alike."""
    apart = differences(one, rows_one, two, rows_two)
    total = one.count[rows_one] + two.count[rows_two]
    shared = (total - apart) / 2
    return np.where(total == 0, 1.0, shared / np.maximum(shared + apart, 1))


class Ladders:
    """The sketches of many texts side by side, each of the size its text needs; any can be folded to smaller ones."""

    def __init__(self, count: np.ndarray, part: np.ndarray):
        self.count, self.part, self.place = count, part, np.zeros(len(count), np.int64)
        self.sketches: dict[int, Sketches] = {}  # by size; ``place`` is a text's row in its own
        self.peeled = np.zeros(len(count), bool)
        self.row, self.key = np.zeros(0, np.int64), np.zeros(0, np.uint64)  # digests of the texts peeled so far

    @classmethod
    def of(cls, d: Digests) -> Ladders:
        """Sketches of the least sizes that can be peeled alone."""
        n = len(d.count)
        out = cls(d.count, FIRST << np.ceil(np.log2(np.maximum(d.count / (FULL * FIRST), 1))).astype(np.int64))
        left, found = np.ones(n, bool), []
        while left.any():
            part = int(out.part[left].min())
            now = np.flatnonzero(left & (out.part == part))
            s = Sketches(len(now), part)
            s.add(*d.take(now), 1)
            trial = s.some(np.arange(len(now)))
            row, key, _ = trial.peel()
            # equal digests by chance are never peeled: a sketch that is far too large stays
            good = ~trial.failed(len(now)) | (s.width > (1 << 20) + 64 * d.count[now])
            out.sketches[part], out.place[now[good]] = s.some(np.flatnonzero(good)), np.arange(good.sum())
            found.append((now[row[good[row]]], key[good[row]]))
            left[now[good]] = False
            out.part[now[~good]] *= 2
        out.peeled[:] = True
        if found:
            out.know(*(np.concatenate(x) for x in zip(*found)))
        return out

    def know(self, row: np.ndarray, key: np.ndarray) -> None:
        order = np.argsort(row, kind="stable")
        self.row, self.key = row[order], key[order]

    def folded(self, rows: np.ndarray, part: int) -> Sketches:
        """The sketches of ``rows``, none smaller, with parts of ``part`` cells."""
        out = Sketches(len(rows), part)
        for size in np.unique(self.part[rows]).tolist():
            at = np.flatnonzero(self.part[rows] == size)
            s = self.sketches[size].some(self.place[rows[at]])
            for name, add in (("count", np.add), ("key", np.bitwise_xor), ("check", np.bitwise_xor)):
                cells = getattr(s, name).reshape(len(at), 3, size // part, part)
                getattr(out, name).reshape(len(rows), 3, part)[at] = add.reduce(cells, axis=2)
        return out

    def alone(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``rows`` and digests of these texts, each peeled from its own sketch."""
        new = np.unique(rows[~self.peeled[rows]])
        found = [(self.row, self.key)]
        for part in np.unique(self.part[new]).tolist():
            for some in pieces(new[self.part[new] == part], part):
                row, key, _ = self.folded(some, part).peel()
                found.append((some[row], key))
        if len(found) > 1:
            self.know(*(np.concatenate(x) for x in zip(*found)))
            self.peeled[new] = True
        first, last = np.searchsorted(self.row, rows), np.searchsorted(self.row, rows, "right")
        size = last - first
        place = np.repeat(np.arange(len(rows)), size)
        return place, self.key[np.arange(len(place)) + (first - (np.cumsum(size) - size))[place]]

    def strings(self) -> list[str]:
        """Each sketch as text: the number of digests, its size, which cells are in use, and these cells."""
        out = [""] * len(self.count)
        for part, s in self.sketches.items():
            rows = np.flatnonzero(self.part == part)
            used = ((s.count != 0) | (s.key != 0)).reshape(-1, s.width)
            cells = np.empty(len(s.count), CELL)
            cells["key"], cells["check"], cells["count"] = s.key, s.check, s.count
            packed = cells[used.ravel()].tobytes()
            ends = (np.cumsum(used.sum(axis=1)) * CELL.itemsize).tolist()
            marks = np.packbits(used, axis=1)
            for i, at in zip(rows.tolist(), self.place[rows].tolist()):
                head = int(self.count[i]).to_bytes(4, "little") + part.bit_length().to_bytes(1, "little")
                out[i] = base64.b64encode(head + marks[at].tobytes() + packed[ends[at - 1] if at else 0 : ends[at]]).decode()
        return out

    @classmethod
    def read(cls, prints: list[str]) -> Ladders:
        """The sketches that ``strings`` has written; an empty string holds no digest."""
        raw = [base64.b64decode(text) for text in prints]
        out = cls(np.array([int.from_bytes(x[:4], "little") for x in raw], np.int64), np.array([1 << x[4] - 1 if x else FIRST for x in raw], np.int64))
        for part in np.unique(out.part).tolist():
            rows = np.flatnonzero(out.part == part)
            s = out.sketches[part] = Sketches(len(rows), part)
            out.place[rows] = np.arange(len(rows))
            marks = -(-s.width // 8)
            for at, i in enumerate(rows.tolist()):
                if raw[i]:
                    used = np.flatnonzero(np.unpackbits(np.frombuffer(raw[i], np.uint8, marks, 5))[: s.width]) + at * s.width
                    cells = np.frombuffer(raw[i], CELL, len(used), 5 + marks)
                    s.key[used], s.check[used], s.count[used] = cells["key"], cells["check"], cells["count"]
        return out


def pieces(rows: np.ndarray, part: int) -> list[np.ndarray]:
    """``rows`` cut so that their sketches have at most CELLS cells at once, or are one."""
    most = max(1, CELLS // (3 * part))
    return [rows[i : i + most] for i in range(0, len(rows), most)]


def ladder_likeness(one: Ladders, rows_one: np.ndarray, two: Ladders, rows_two: np.ndarray) -> np.ndarray:
    """Shared digests over all digests of each pair, exactly, from their sketches alone; two texts without any are alike."""
    total = one.count[rows_one] + two.count[rows_two]
    apart = np.zeros(len(rows_one), np.int64)
    part = np.minimum(one.part[rows_one], two.part[rows_two])
    least = np.abs(one.count[rows_one] - two.count[rows_two])
    left = least > 3 * part  # fewer cells cannot hold the difference
    for size in np.unique(part[~left]).tolist():
        for now in pieces(np.flatnonzero(~left & (part == size)), size):
            s, other = one.folded(rows_one[now], size), two.folded(rows_two[now], size)
            s.count, s.key, s.check = s.count - other.count, s.key ^ other.key, s.check ^ other.check
            row, _, _ = s.peel()
            apart[now] = np.bincount(row, minlength=len(now))
            left[now[s.failed(len(now))]] = True
    left = np.flatnonzero(left)
    if len(left):
        (row, key), (other, more) = one.alone(rows_one[left]), two.alone(rows_two[left])
        row, key = np.concatenate([row, other]), np.concatenate([key, more])
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        both = np.bincount(row[1:][(row[1:] == row[:-1]) & (key[1:] == key[:-1])], minlength=len(left))
        apart[left] = total[left] - 2 * both
    shared = (total - apart) / 2
    return np.where(total == 0, 1.0, shared / np.maximum(shared + apart, 1))


def fingerprints(d: Digests) -> list[str]:
    """The sketch of each text, as text; equal texts have equal ones."""
    return Ladders.of(d).strings()


def _likeness(one: pd.Series, two: pd.Series) -> pd.Series:
    both = (one.notna() & two.notna()).to_numpy()
    out = pd.Series([None] * len(one), dtype="Float64")
    rows = np.arange(both.sum())
    out[both] = ladder_likeness(Ladders.read(one[both].tolist()), rows, Ladders.read(two[both].tolist()), rows)
    return out


def likeness_of(one: str, two: str) -> Column:
    """Likeness of two columns of fingerprints, from these values alone (null: null)."""
    return F.pandas_udf(_likeness, T.DoubleType())(one, two)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; and to the next document.

    The next document is that of the next smaller ``doc_id``, after the last
    the first; null ids are last, equal ids go by text.  The edited text has
    the last half of its code points replaced by as many of the next one's
    first (or all).  A null text is empty, an empty table gives no row, a
    single row is followed by itself; other columns are ignored.  The likeness
    is that of the two fingerprints, from these values alone, and exact.  A
    fingerprint grows with the number of different paragraphs of its text.

    One shuffle of the texts: ranges of doc_id, sorted inside; each range also
    gets the first row of the range behind it, one row per range.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    bounds = chunk_bounds(rows, "doc_id", partitions(spark))
    cut = with_chunk(rows, "doc_id", bounds)
    firsts = sorted(((r.chunk, r.first) for r in cut.groupBy("chunk").agg(F.max("doc_id").alias("first")).collect()), reverse=True)
    guests = spark.createDataFrame([(chunk, firsts[(i + 1) % len(firsts)][1]) for i, (chunk, _) in enumerate(firsts)], "chunk int, doc_id long")
    guests = F.broadcast(guests.withColumnRenamed("doc_id", "guest_id"))  # one row per range
    guests = rows.join(guests, F.col("doc_id").eqNullSafe(F.col("guest_id"))).groupBy("doc_id", "chunk").agg(F.min("text").alias("text"))
    both = cut.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))
    laid = both.repartitionById(len(bounds) + 1, F.col("chunk")).sortWithinPartitions("chunk", "guest", F.col("doc_id").desc_nulls_last(), "text")

    def work(batches):
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "guest")))
            yield from _compared(held)
            held = held[-1:]

    return by_task(laid, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", work)


def _compared(rows: list[tuple]):
    """Every row but the last and guests, with the row behind it."""
    whole = [text for _, text, _ in rows]
    here = np.array([i for i in range(len(rows) - 1) if not rows[i][2]], np.int64)
    if not len(here):
        return
    edited = [whole[i][: len(whole[i]) - len(whole[i]) // 2] + whole[i + 1][: len(whole[i]) // 2] for i in here]
    plain, changed = Ladders.of(Digests(whole)), Ladders.of(Digests(edited))
    prints = plain.strings()
    yield {
        "doc_id": [rows[i][0] for i in here], "n_chars": [len(whole[i]) for i in here],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        "fingerprint": [prints[i] for i in here], "edited_fingerprint": changed.strings(),
        "near_edited": ladder_likeness(plain, here, changed, np.arange(len(here))), "near_next": ladder_likeness(plain, here, plain, here + 1),
    }
