"""Centroid clustering in whole numbers, with Ptolemaic pivots in front of the exact distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outpulse.llm.common import by_batch, by_task, saved, stored

PIVOTS = 16
LARGEST = 1 << 27  # of a component's size: a distance of 64 of them fits a long
EPS = float(np.finfo(np.float64).eps)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors, row by row."""
    return ((x - y) ** 2).sum(axis=-1)


def far_apart(points: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` different points, each the farthest from those before it."""
    chosen, least = [0], squared(points, points[0])
    while len(chosen) < k and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(points, points[chosen[-1]]))
    return points[chosen]


class Pivots:
    """Fixed points and the pairs of them that bound a distance from below.

    Ptolemy's inequality: d(x, c) d(p, q) >= |d(x, p) d(c, q) - d(x, q) d(c, p)|.
    d(x, p) is computed once per vector and kept; each round needs only d(c, p).
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        self.pairs = [(i, i + 1) for i in range(n - 1)]
        self.apart = [float(np.sqrt(squared(points[i], points[j]))) for i, j in self.pairs]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances to every pivot, a row per vector."""
        return np.stack([squared(x, p) for p in self.points], axis=1)

    def bounds(self, near: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, rounded down.

        Each root and product is off by less than EPS of itself, so four EPS of
        both products cover the difference; what follows loses less than 16 EPS.
        """
        dx, dc = np.sqrt(near.astype(np.float64)), np.sqrt(self.distances(centroids).astype(np.float64))
        best = np.zeros((len(near), len(centroids)))
        for (p, q), apart in zip(self.pairs, self.apart):
            left, right = np.outer(dx[:, p], dc[:, q]), np.outer(dx[:, q], dc[:, p])
            np.maximum(best, (np.abs(left - right) - 4 * EPS * (left + right)) / apart, out=best)
        return best * best * (1 - 16 * EPS)


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (ties: the smaller), its squared distance, and how many distances were computed.

    Centroids are met in order of their bounds; a vector is done as soon as the
    next bound exceeds its best exact distance.  Equal bounds go on, for ties.
    """
    bound = pivots.bounds(near, centroids)
    order = np.argsort(bound, axis=1, kind="stable")
    rows = np.arange(len(x))
    which = order[:, 0].copy()
    best = squared(x, centroids[which])
    computed = len(x)
    for rank in range(1, len(centroids)):
        rows = rows[bound[rows, order[rows, rank]] <= best[rows]]
        if not len(rows):
            break
        c = order[rows, rank]
        d = squared(x[rows], centroids[c])
        computed += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (c < which[rows]))
        best[rows[better]], which[rows[better]] = d[better], c[better]
    return which, best, computed


def whole(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and ``v`` (floor of ``scale`` times each component) of the vectors that count."""
    x = F.col("embedding")
    valid = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    fits = lambda c: F.when(F.abs(c.cast("double")) * scale <= LARGEST, F.floor(c.cast("double") * scale))
    ints = F.transform(x, lambda c: F.coalesce(fits(c), F.raise_error(F.lit(f"a component of more than {LARGEST} / {scale}")).cast("long")).cast("int"))
    return vectors.where(F.coalesce(valid, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def starting(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors of the smallest sha256 of ``seed`` and id, in that order; null ids last, equal ids by vector."""
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256)
    return np.array([r[0] for r in kept.orderBy(order.asc_nulls_last(), "v").select("v").limit(k).collect()], np.int64)


def moved(placed: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Centroids after a round: exact floor of sum by count of their vectors; empty ones stay.

    A task leaves one row of sums per centroid; ``k`` times ``dims`` totals reach the driver.
    """
    k, dims = centroids.shape

    def work(batches):
        sums, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = matrix(batch.column("v"), dims)
            which, _, _ = nearest(x, matrix(batch.column("near"), len(pivots.points)), centroids, pivots)
            np.add.at(sums, which, x)
            count += np.bincount(which, minlength=k)
        met = np.flatnonzero(count)
        yield {"cluster": met, "n": count[met], "sums": list(sums[met])}

    parts = by_task(placed.select("v", "near"), "cluster int, n long, sums array<long>", work)
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("i", "x")).groupBy("cluster", "i").agg(exact("x").alias("x"), exact("n").alias("n"))
    out = centroids.copy()
    for cluster, i, x, n in totals.collect():
        out[cluster, i] = int(x) // int(n)
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1:") -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256`` per vector.

    Kept are vectors of exactly ``dims`` components, none null or non-finite;
    components become whole numbers, so every sum is exact in any order and a
    lost task gives the same result again.  The vectors and their distances to
    the pivots are written once; every round reads them and sends ``k`` sums
    per task.  A null id is kept but never starts a centroid before others;
    repeated rows each count; fewer vectors than ``k`` give fewer clusters; an
    empty table gives no row; other columns are ignored.  A component of more
    than ``LARGEST / scale`` is an error, since its distance fits no long.
    There are no texts here, so none can be long; a vector of another length is left out.
    """
    kept = whole(vectors, dims, scale)
    centroids = starting(kept, k, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    pivots = Pivots(far_apart(centroids, PIVOTS))

    def measured(batch):
        v = batch.column("v")
        return {"vec_id": batch.column("vec_id"), "v": v, "near": list(pivots.distances(matrix(v, dims)))}

    placed = stored(by_batch(kept, "vec_id long, v array<int>, near array<long>", measured), "vectors")
    for _ in range(rounds):
        centroids = moved(placed, centroids, pivots)

    def last(batch):
        which, best, _ = nearest(matrix(batch.column("v"), dims), matrix(batch.column("near"), len(pivots.points)), centroids, pivots)
        return {"vec_id": batch.column("vec_id"), "cluster": which, "distance": best}

    found = saved(by_batch(placed, "vec_id long, cluster int, distance long", last))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(exact).collect()}  # k rows
    about = [(c, s, sum(sums.values()), ",".join(map(str, centroids[c]))) for c, s in sums.items()]
    few = vectors.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid string")
    few = few.withColumn("centroid_sha256", F.sha2(F.col("centroid").cast("binary"), 256)).drop("centroid")
    return found.join(F.broadcast(few), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
