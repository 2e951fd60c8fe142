"""Centroid clustering of vectors in exact integers, with Ptolemaic pivots.

The pivots are the vectors that the centroids start from, so they stay fixed while the centroids move.  A vector's
squared distances to them are worked out once and kept with it.  For two pivots p and q, Ptolemy's inequality bounds
the distance of a vector x and a centroid c from below: |d(x,p) d(c,q) - d(x,q) d(c,p)| / d(p,q).  Centroid number k
is bounded by fixed pairs of its own pivot k with others.  Bounds are rounded down by more than any rounding error,
and every centroid whose bound does not exceed the best exact distance so far is measured exactly, in integers; so
results are those of measuring all.

What leaves a task are its sums for each cluster; the driver holds k centroids, never rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Components are multiplied by this and rounded down; integers end at MOST, so that squared distances fit a long.
SCALE, MOST = 64, 1 << 27
#: Pivots that a centroid's own pivot is paired with.
PARTNERS = 4
#: Share by which bounds are lowered and upper bounds raised: a hundred times the rounding of the few operations.
SLACK = 1e-13


def integers(column: Column, size: int) -> Column:
    """floor(64 * x) of every component, or null unless there are ``size`` finite ones."""
    sound = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    limit = float(MOST // SCALE)
    scaled = F.transform(
        column, lambda x: F.floor(F.greatest(F.least(x.cast("double"), F.lit(limit)), F.lit(-limit)) * SCALE).cast("int")
    )
    return F.when((F.size(column) == size) & sound, scaled)


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to one centroid, or to one each."""
    gap = x - centroid
    return np.einsum("ij,ij->i", gap, gap)


class Pivots:
    """The fixed pivots and, for each of them, the pairs that bound its centroid."""

    def __init__(self, vectors: np.ndarray, partners: int = PARTNERS):
        self.vectors, n = vectors, len(vectors)
        self.apart = np.sqrt(np.array([squared(vectors, v) for v in vectors]).reshape(n, n).astype(float))
        steps = [max(1, round(n * (i + 1) / (partners + 1))) for i in range(partners)]
        self.partners = [sorted({(k + s) % n for s in steps if self.apart[k, (k + s) % n] > 0}) for k in range(n)]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """(rows, pivots): exact squared distances, which are kept with the vectors."""
        return np.stack([squared(x, p) for p in self.vectors], axis=1)

    def bounds(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """(rows, centroids): no more than the squared distance of a row and a centroid."""
        rows, others = np.sqrt(cached.astype(float)), np.sqrt(self.distances(centroids).astype(float))
        low = np.zeros((len(cached), len(centroids)))
        for k in range(len(centroids)):
            for q in self.partners[k]:
                a, b = rows[:, k] * others[k, q], rows[:, q] * others[k, k]
                low[:, k] = np.maximum(low[:, k], (np.abs(a - b) - SLACK * (a + b)) / self.apart[k, q])
        return low * low * (1 - SLACK)


def assign(x: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, distances measured): ties go to the smaller number."""
    low = pivots.bounds(cached, centroids)
    best = low.argmin(axis=1)
    found = squared(x, centroids[best])
    start, measured = best.copy(), len(x)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero((start != k) & (low[:, k] <= found * (1 + SLACK)))
        measured += len(rows)
        d = squared(x[rows], centroid)
        nearer = (d < found[rows]) | ((d == found[rows]) & (k < best[rows]))
        best[rows[nearer]], found[rows[nearer]] = k, d[nearer]
    return best, found, measured


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _with_pivots(pivots: Pivots):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                near = pivots.distances(_matrix(batch.column(1), np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, _lists(near, pa.int64())], names=["id", "e", "near"])

    return run


def _sums(centroids: np.ndarray, pivots: Pivots):
    """A row for each cluster that the task meets: how many vectors, their components' sums, distances measured."""

    def run(batches: Iterator[pa.RecordBatch]):
        counts, sums, measured = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), np.int64)
                best, _, n = assign(x, _matrix(batch.column(2), np.int64), centroids, pivots)
                np.add.at(counts, best, 1)
                np.add.at(sums, best, x)
                measured += n
        met = np.flatnonzero(counts)
        if len(met):
            columns = [pa.array(met, pa.int32()), pa.array(counts[met]), _lists(sums[met], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])

    return run


def _nearest(centroids: np.ndarray, pivots: Pivots):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                best, found, _ = assign(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), np.int64), centroids, pivots)
                columns = [batch.column(0), pa.array(best.astype(np.int32)), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    return run


def moved(held: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Each centroid as the rounded-down mean of the vectors nearest to it; where there are none it stays."""
    parts = held.mapInArrow(_sums(centroids, pivots), "cluster int, n long, sums array<long>")
    whole = F.sum(F.col("x").cast("decimal(38,0)")).alias("total")
    means = (
        parts.select("cluster", "n", F.posexplode("sums").alias("place", "x"))
        .groupBy("cluster", "place")
        .agg(whole, F.sum("n").alias("n"))
        .collect()  # k rows for each component
    )
    out = centroids.copy()
    for row in means:
        out[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return out


def starts(held: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors of the smallest hashes of their ids; null ids last, equal ids by their components."""
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    first = held.select("e", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "e").limit(k).collect()
    return np.array([row["e"] for row in first], np.int64)


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, k: int = 16, rounds: int = 3, seed: str = "1:"
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector that takes part.

    Vectors that are null, hold null or non-finite components or another number of them than ``size`` take no part.
    Components are floor(64 * x), those beyond 2 ** 27 in size are held to it.  ``k`` vectors, fewer if there are
    fewer rows, are the first centroids; in each round vectors go to the nearest (ties: the smaller number) and
    centroids to the rounded-down mean of theirs; at the end vectors are assigned once more.  Distances are squared,
    sums of them end at the largest long.  Repeated rows and rows with a null id count like any other, equal starting
    vectors give a cluster that stays empty.  No rows give none; other columns take no part.
    """
    ids = F.col(f"`{id_col}`")
    sound = vectors.select(ids.alias("id"), integers(F.col(f"`{vector_col}`"), size).alias("e")).where("e is not null")
    kind = sound.schema["id"].dataType.simpleString()
    centroids = starts(sound, k, seed)
    if not len(centroids):
        return sound.select(
            F.col("id").alias(id_col),
            *(F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))),
        )
    pivots = Pivots(centroids)
    held = checkpointed(sound.mapInArrow(_with_pivots(pivots), f"id {kind}, e array<int>, near array<long>"))
    for _ in range(rounds):
        centroids = moved(held, centroids, pivots)
    found = checkpointed(held.mapInArrow(_nearest(centroids, pivots), f"id {kind}, cluster int, distance long"))
    sums = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # k rows
    top = (1 << 63) - 1
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, min(int(s), top), min(int(sum(sums.values())), top), marks[c]) for c, s in sums.items()]
    facts = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(facts), "cluster")  # k rows at most
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
