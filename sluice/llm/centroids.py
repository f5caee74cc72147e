"""Clustering around centroids, where the threshold algorithm finds the nearest centroid.

For every dimension the centroids are kept as a sorted list. From a vector's own value each
list is walked outwards, nearest centroid first, all lists by one step at a time. A centroid
that is met for the first time is measured exactly. One that no list has met yet is, in
every dimension, at least as far away as that list's frontier; so once the frontiers'
squared distances add up to strictly more than the best exact distance, no other centroid
can win or tie, and the walk stops.

Everything is integer arithmetic, hence exact and independent of the order of rows. Vectors
are read where they are stored; a round moves one partial sum per task and centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.sources.staging import Staging

SCALE = 256
# Integers up to this size: 64 squared differences still add up to less than 2^63.
LARGEST = 1 << 27
# Further away than any centroid in a dimension; stands beyond both ends of a list.
BEYOND = (1 << 28) + 1
BLOCK = 4096  # vectors that walk side by side
FAR = np.iinfo(np.int64).max


class SortedCentroids:
    """The sorted list of every dimension, walked outwards for many vectors at once."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids.astype(np.int64)
        k, dims = self.centroids.shape
        order = np.argsort(self.centroids, 0, kind="stable")
        self.values = np.zeros((dims, k + 2), np.int64)
        self.ids = np.zeros((dims, k + 2), np.int64)
        self.values[:, 1:-1] = np.take_along_axis(self.centroids, order, 0).T
        self.ids[:, 1:-1] = order.T

    def _gaps(self, x: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the next centroid on either side, BEYOND where a list ends."""
        dim = np.arange(x.shape[1])
        below = np.where(left > 0, x - self.values[dim, left], BEYOND)
        above = np.where(right <= len(self.centroids), self.values[dim, right] - x, BEYOND)
        return below, above

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance); ties go to the smaller number."""
        x = vectors.astype(np.int64)
        (n, dims), k = x.shape, len(self.centroids)
        who, best = np.zeros(n, np.int64), np.full(n, FAR)
        rows, dim = np.arange(n), np.arange(dims)
        left = np.stack([np.searchsorted(self.values[j, 1:-1], x[:, j]) for j in dim], 1)
        right, seen = left + 1, np.zeros((n, k), bool)
        while rows.size:
            below, above = self._gaps(x, left, right)
            step_left = below <= above
            met = np.where(step_left, self.ids[dim, left], self.ids[dim, right])
            some = np.minimum(below, above) < BEYOND
            now = np.zeros_like(seen)
            now[np.broadcast_to(np.arange(len(rows))[:, None], met.shape)[some], met[some]] = True
            vector, centroid = np.nonzero(now & ~seen)
            exact = ((x[vector] - self.centroids[centroid]) ** 2).sum(1)
            distances = np.full(seen.shape, FAR)
            distances[vector, centroid] = exact
            nearest = distances.argmin(1)  # the smallest number of equal ones
            distance = distances[np.arange(len(rows)), nearest]
            better = (distance < best[rows]) | (distance == best[rows]) & (nearest < who[rows])
            who[rows[better]], best[rows[better]] = nearest[better], distance[better]
            seen |= now
            left, right = left - step_left, right + ~step_left
            left, right = np.maximum(left, 0), np.minimum(right, k + 1)
            frontier = np.minimum(*self._gaps(x, left, right))
            going = ((frontier**2).sum(1) <= best[rows]) & ~seen.all(1)
            rows, x, left, right, seen = rows[going], x[going], left[going], right[going], seen[going]
        return who, best

    def nearest_in_blocks(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.nearest(vectors[i : i + BLOCK]) for i in range(0, len(vectors), BLOCK)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(map(np.concatenate, zip(*parts)))


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(sizes of lists, all their values); a null list has size -1."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    return sizes.astype(np.int64), column.flatten()


def whole_vectors(rows: DataFrame, vector: str, dims: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<int>): vectors of `dims` finite components as floor(scale * component)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, values = _flat(batch.column("x"))
            ends = np.cumsum(np.maximum(sizes, 0))
            fits = np.flatnonzero(sizes == dims)
            places = (ends[fits] - dims)[:, None] + np.arange(dims)
            usable = values.is_valid().to_numpy(zero_copy_only=False)
            numbers = values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
            usable &= np.isfinite(numbers)
            keep = usable[places].all(1)
            scaled = np.floor(scale * numbers[places[keep]])
            if scaled.size and np.abs(scaled).max() > LARGEST:
                raise ValueError(f"components beyond {LARGEST // scale} in size have no exact distance as a long")
            kept = scaled.astype(np.int32).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(fits[keep])),
                    pa.ListArray.from_arrays(pa.array(np.arange(keep.sum() + 1) * dims, pa.int32()), pa.array(kept)),
                ],
                names=["vec_id", "x"],
            )

    narrow = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    return narrow.mapInArrow(run, "vec_id bigint, x array<int>")


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the least hash of `seed` and their id, in that order."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    chosen = vectors.orderBy(digest.asc_nulls_last(), "x").limit(k).collect()
    return np.array([row.x for row in chosen], np.int64)


def moved_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid replaced by the floored mean of its vectors, if it has any."""
    k, dims = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedCentroids(centroids)
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch, dims)
            own, _ = lists.nearest_in_blocks(x)
            order = np.argsort(own, kind="stable")
            there, first = np.unique(own[order], return_index=True)
            if there.size:
                sums[there] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
            counts += np.bincount(own, minlength=k)
        some = np.flatnonzero(counts)
        places = pa.array(np.arange(len(some) + 1) * dims, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array(counts[some]),
                pa.ListArray.from_arrays(places, pa.array(sums[some].ravel())),
            ],
            names=["cluster", "n", "sums"],
        )

    partial = vectors.select("x").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    totals = [F.sum(F.col("sums")[j]) for j in range(dims)]
    moved = centroids.copy()
    for row in partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*totals).alias("sums")).collect():
        moved[row.cluster] = [total // row.n for total in row.sums]  # rounds down, also below zero
    return moved


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dims = centroids.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedCentroids(centroids)
        for batch in batches:
            own, distance = lists.nearest_in_blocks(_matrix(batch, dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(own.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return vectors.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def cluster_vectors(
    rows: DataFrame,
    vector: str = "embedding",
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    seed: str = "2:",
    staging: Staging | None = None,
) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, have not exactly `dims` components, or hold null, NaN or infinite
    ones take no part. Components become floor(256 * x); beyond 2^19 in size they raise,
    because squared distances would not fit a long. A null vec_id takes part, but is the last
    choice as a first centroid. Rows that repeat a vec_id are vectors of their own; of
    equal ids the smaller vector is the earlier first centroid. With fewer than `k` vectors
    each is a centroid; an empty table gives no rows. Other columns are ignored.

    Vectors are stored once as integers; each round reads them and shuffles at most `k` rows
    a task. `k` centroids and `k` inertias pass the driver.
    """
    spark = rows.sparkSession
    staging = staging or Staging(spark)
    vectors = staging.pin(whole_vectors(rows, vector, dims), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = moved_centroids(vectors, centroids)
    found = staging.pin(assigned(vectors, centroids), "assigned")
    inertias = found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    total = sum(row.inertia for row in inertias)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(row.cluster, row.inertia, total, digests[row.cluster]) for row in inertias],
        "_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    joined = found.join(F.broadcast(facts), F.col("cluster") == F.col("_cluster"))
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
