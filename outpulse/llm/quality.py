"""Quality by compression: zstandard dictionaries of good and of bad text, size difference to score."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outpulse.llm.common import by_batch, by_task, labelled_texts, saved
from outpulse.llm.toxicity import scored

SAMPLE = 6_000  # labelled documents learnt from at most: half for the dictionaries, half for the calibration
BLOCK = 1024  # bytes compressed at once, so that a dictionary weighs the same in long and short texts
BLOCKS = 16_000  # per class that a dictionary is trained on at most: what bounds the one training task
DICTIONARY = 1 << 17  # bytes at most


def blocks(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(256, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


@lru_cache(maxsize=4)
def compressor(content: bytes) -> zstandard.ZstdCompressor:
    found = zstandard.ZstdCompressionDict(content) if content else None
    if found:
        found.precompute_compress(level=1)
    return zstandard.ZstdCompressor(level=1, dict_data=found, write_content_size=False, write_checksum=False, write_dict_id=False)


def difference(text: str, bad: bytes, good: bytes) -> float:
    """Bytes saved by the good dictionary over the bad one per byte of text (empty: 0)."""
    parts = blocks(text)
    with_bad, with_good = (sum(len(compressor(d).compress(b)) for b in parts) for d in (bad, good))
    return (with_bad - with_good) / (sum(map(len, parts)) + len(parts)) if parts else 0.0


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression's weights (intercept first) by Newton's steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + ridge * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE, most: int = BLOCKS) -> tuple[bytes, bytes, list[float]]:
    """The bad and the good dictionary and the calibration (intercept, difference).

    The dictionaries learn from ``most`` blocks of the sample per class at most, in
    hash order.  A class without samples has an empty dictionary; with one class alone, or
    no label at all, the calibration is the smoothed share of good labels.
    """
    rows = saved(labelled_texts(docs, labels, target, sample).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))))

    def cut(batch):
        out = {"label": [], "at": [], "block": []}
        for doc_id, text, label in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label"))):
            for i, b in enumerate(blocks(text)):
                out["label"].append(label)
                out["at"].append(xxhash.xxh64_intdigest(f"{doc_id} {i}") >> 1)
                out["block"].append(b)
        return out

    cuts = by_batch(rows.where("part = 0"), "label int, at long, block binary", cut)
    few = cuts.where("label = 0").orderBy("at", "block").limit(most).unionByName(cuts.where("label = 1").orderBy("at", "block").limit(most))

    def train(batches):
        found: dict[int, list[bytes]] = {0: [], 1: []}
        for batch in batches:
            for label, block in zip(batch.column("label").to_pylist(), batch.column("block").to_pylist()):
                found[label].append(block)
        yield {"label": [0, 1], "content": [dictionary(sorted(found[k], key=xxhash.xxh64_digest)) if found[k] else b"" for k in (0, 1)]}

    trained = {r.label: bytes(r.content) for r in by_task(few.repartition(1), "label int, content binary", train).collect()}
    bad, good = trained.get(0, b""), trained.get(1, b"")

    def measure(batch):
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "difference": [difference(t, bad, good) for t in batch.column("text").to_pylist()]}

    seen = by_batch(rows.where("part = 1"), "doc_id long, label int, difference double", measure).orderBy("doc_id").collect()
    y = np.array([r.label for r in seen], float)
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 1) / (len(y) + 2)
        return bad, good, [float(np.log(share / (1 - share))), 0.0]
    return bad, good, calibrated(np.array([r.difference for r in seen]), y).tolist()


def score(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = 0.7, sample: int = SAMPLE, most: int = BLOCKS) -> DataFrame:
    """Adds ``held_out``, ``score`` (0 to 1, higher: good likelier) and ``predicted`` to every row of ``docs``.

    Both dictionaries (DICTIONARY bytes at most each) are broadcast; every
    block of every whole text is compressed with both.  A null text is scored
    as empty (the intercept); a row that occurs twice is scored twice; empty
    tables give no row.  The columns of ``docs`` stay; of the same names, the
    new ones win.
    """
    bad, good, weights = fit(docs, labels, target, sample, most)
    model = docs.sparkSession.sparkContext.broadcast((bad, good, weights))

    def margin(text: str) -> float:
        d_bad, d_good, (intercept, slope) = model.value
        return intercept + slope * difference(text, d_bad, d_good)

    return scored(docs, margin, threshold)
