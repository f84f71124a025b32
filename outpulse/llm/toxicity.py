"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from outpulse.llm.common import ROWS_PER_BATCH, by_batch, by_task, held_out, labelled_texts, saved, words

SAMPLE = 8_000  # labelled documents learnt from at most
STEM = 5  # letters of a word's stem, which counts beside the word
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
KINDS = np.array([0x51ED270B, 0x2545F491, 0x6C62272E, 0x7F4A7C15], np.uint64)  # word, stem, pair, skip-gram


class WordIds(dict):
    """Word to its row in a table of hashes (word, stem); emptied by its owner."""

    def __init__(self, entries: int = 400_000):
        super().__init__()
        self.entries = entries
        self.table = np.zeros((1 << 12, 2), np.uint64)

    def __missing__(self, w: str) -> int:
        k = len(self)
        if k == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[k] = xxhash.xxh64_intdigest(w), xxhash.xxh64_intdigest(w[:STEM])
        self[w] = k
        return k


class Hasher:
    """64-bit features of a text: words, stems, neighbours and pairs with one word between."""

    def __init__(self):
        self.known = WordIds()

    def features(self, text: str) -> np.ndarray:
        if len(self.known) > self.known.entries:
            self.known = WordIds()
        known = self.known
        at = np.array([known[w] for w in words(text)], np.int64)
        word, stem = known.table[at].T
        parts = [word ^ KINDS[0], stem ^ KINDS[1]]
        for kind, gap in ((2, 1), (3, 2)):
            left, right = word[:-gap], word[gap:]
            parts.append((left * MULTIPLY + (right >> np.uint64(7)) * np.uint64(3)) ^ KINDS[kind])
        return (np.concatenate(parts) * MULTIPLY).view(np.int64)


_HASHER = Hasher()


def frequent(rows: list[np.ndarray], least: int, parts: int = 16) -> np.ndarray:
    """Features of at least ``least`` rows, in order; counted part by part, so that one part's copies are held at once."""
    kept = [np.zeros(0, np.int64)]
    for k in range(parts if rows else 0):
        distinct, seen = np.unique(np.concatenate([r[r & (parts - 1) == k] for r in rows]), return_counts=True)
        kept.append(distinct[seen >= least])
    return np.sort(np.concatenate(kept))


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.2, least: int = 3) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with weights other than zero, their weights and the intercept.

    Each coordinate has its own rate, alpha / (beta + root of its summed squared
    gradients); l1 keeps a weight at zero until its gradients outweigh it.  The
    intercept is a coordinate without l1.
    """
    distinct = frequent(rows, least)
    index = []
    for r in rows:
        at = np.searchsorted(distinct, r)
        at[at == len(distinct)] = 0
        index.append(at[distinct[at] == r] if len(distinct) else at[:0])
    z, n = np.zeros(len(distinct)), np.zeros(len(distinct))
    z0 = n0 = w0 = 0.0
    order = np.arange(len(rows))
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for k in order:
            i = index[k]
            zi, ni = z[i], n[i]
            w = np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)
            w0 = -z0 / ((beta + n0**0.5) / alpha + l2)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + w0, -35, 35))) - labels[k]
            more = np.sqrt(ni + g * g)
            z[i] += g - (more - np.sqrt(ni)) / alpha * w
            n[i] += g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / alpha * w0
            n0 += g * g
    w = np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    kept = w != 0
    return distinct[kept], w[kept], float(-z0 / ((beta + n0**0.5) / alpha + l2))


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """The model as rows (feature, weight); feature null is the intercept.

    Learns from at most ``sample`` labelled documents outside the held-out
    fold.  Their features are made in many tasks; the descent itself is in its
    nature one pass after the other and runs in one task over that bounded
    sample.  Without any label the intercept alone is returned, minus 3.
    """
    rows = labelled_texts(docs, labels, target, sample)

    def features(batch):
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "features": [np.unique(_HASHER.features(t)).tobytes() for t in batch.column("text").to_pylist()]}

    hashed = saved(by_batch(rows, "doc_id long, label int, features binary", features))

    def learn(batches):
        found, y = [], []
        for batch in batches:
            found += [(d, np.frombuffer(f, np.int64)) for d, f in zip(batch.column("doc_id").to_pylist(), batch.column("features").to_pylist())]
            y += batch.column("label").to_pylist()
        order = sorted(range(len(y)), key=lambda i: found[i][0])
        feature, weight, intercept = ftrl([found[i][1] for i in order], np.array([y[i] for i in order], float))
        yield {"feature": [*feature.tolist(), None], "weight": [*weight.tolist(), intercept if y else -3.0]}

    return by_task(hashed.repartition(1), "feature long, weight double", learn)


def score(docs: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """Adds ``held_out``, ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` to every row of ``docs``.

    The model's weights, no more than the sample's features and few for l1, are
    broadcast.  A null text is scored as empty (the intercept); a row that
    occurs twice is scored twice; empty tables give no row.  The columns of
    ``docs`` stay; of the same names, the new ones win.
    """
    model = fit(docs, labels, target, sample).collect()
    pairs = sorted((r.feature, r.weight) for r in model if r.feature is not None)
    intercept = next((r.weight for r in model if r.feature is None), -3.0)
    known = docs.sparkSession.sparkContext.broadcast((np.array([f for f, _ in pairs], np.int64), np.array([w for _, w in pairs], float)))

    def margin(text: str) -> float:
        feature, weight = known.value
        if not len(feature):
            return intercept
        found = _HASHER.features(text)
        at = np.searchsorted(feature, found)
        at[at == len(feature)] = 0
        hits = np.unique(at[feature[at] == found])
        return intercept + float(weight[hits].sum())

    return scored(docs, margin, threshold)


def scored(docs: DataFrame, margin, threshold: float) -> DataFrame:
    """The rows of ``docs`` with the score that ``margin`` gives each whole text, in one pass."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))

    @arrow_udf("double")
    def of(column):
        return pa.array([1 / (1 + np.exp(-np.clip(margin(t), -35, 35))) for t in column.to_pylist()], pa.float64())

    out = docs.withColumn("score", of(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return out.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


