"""Clustering around centroids, with the threshold algorithm as the search for the nearest one.

Vectors are whole numbers: each component x becomes floor(`SCALE` * x). Per dimension the centroids stand in
a list sorted by value. For a vector, every list is walked outward from the vector's own value, nearest value
first, all lists one step at a time. A centroid met for the first time gets its exact distance. The squared gaps
at the frontiers add up to a bound that no centroid still unmet can undercut; a vector is settled as soon as
the bound strictly exceeds its best distance, so equally near centroids are all met and the smallest number wins.

The centroids (`k` vectors) are all that the driver holds. A round is one scan: every task assigns its
vectors and hands over one sum per cluster; the sums are added up by an ordinary aggregate. All of
it is whole-number arithmetic, so any partitioning gives the same result.

Defined cases: vectors that are null, have another length than `DIMENSIONS`, or hold a null or a non-finite
component are left out, as are those with a component beyond 2^27 in whole numbers, whose distance no long holds.
Repeated vectors are equal; repeated ids are different vectors, and among equal start hashes the smaller vector is
first. With fewer than `k` vectors there are fewer centroids, which may be equal; a cluster without vectors keeps
its centroid. An empty table gives an empty result; only the id and the vector column are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import cut_lineage

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
# Largest whole-number component: the squared distance over all dimensions still fits a long.
LARGEST = 1 << 27
# Vectors assigned at once.
BATCH = 1024
ASSIGNED = "id {id}, cluster int, distance long"


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """(id, v): the usable vectors as whole numbers."""
    scaled = F.transform(F.col("v"), lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))))
    fits = F.forall(F.col("v"), lambda x: F.coalesce(F.abs(F.floor(x.cast("double") * F.lit(float(SCALE)))) <= LARGEST, F.lit(False)))
    finite = F.forall(F.col("v"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return (
        vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
        .where(F.coalesce(F.size("v") == dimensions, F.lit(False)) & finite)
        .where(fits)
        .select("id", scaled.alias("v"))
    )


def start_centroids(whole: DataFrame, k: int = CENTROIDS, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The `k` vectors with the smallest hash of their id; every task keeps `k` of its own."""
    mark = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = whole.orderBy(mark, F.col("id").isNull(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), dimensions)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, centroids whose exact distance was taken) per vector, by the threshold algorithm."""
    n, k = len(vectors), len(centroids)
    best = np.full(n, np.iinfo(np.int64).max)
    cluster = np.zeros(n, np.int64)
    taken = np.zeros(n, np.int64)
    if not n or not k:
        return cluster, best, taken
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(centroids.shape[1])
    live = np.arange(n)
    # right: the next entry at or above the own value; left: the next one below it
    right = np.stack([np.searchsorted(lists[:, d], vectors[:, d]) for d in dims], axis=1)
    left = right - 1
    seen = np.zeros((n, k), bool)
    far = np.iinfo(np.int64).max
    for _ in range(k):
        v = vectors[live]
        down = np.where(left >= 0, v - lists[np.maximum(left, 0), dims], far)
        up = np.where(right < k, lists[np.minimum(right, k - 1), dims] - v, far)
        lower = down <= up
        met = order[np.where(lower, left, right), dims]
        gap = np.where(lower, down, up)
        left, right = left - lower, right + ~lower
        fresh = np.zeros((len(live), k), bool)
        fresh[np.arange(len(live))[:, None], met] = True
        fresh &= ~seen[live]
        seen[live] |= fresh
        at, number = np.nonzero(fresh)
        distance = np.full((len(live), k), far)
        distance[at, number] = ((v[at] - centroids[number]) ** 2).sum(axis=1)
        taken[live] += fresh.sum(axis=1)
        # the smallest number among the nearest fresh ones, then against what was best
        number = distance.argmin(axis=1)
        found = distance[np.arange(len(live)), number]
        better = (found < best[live]) | ((found == best[live]) & (number < cluster[live]) & (found < far))
        best[live[better]], cluster[live[better]] = found[better], number[better]
        open_ = (gap**2).sum(axis=1) <= best[live]
        live, left, right = live[open_], left[open_], right[open_]
        if not len(live):
            break
    return cluster, best, taken


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BATCH):
            part = batch.slice(lo, BATCH)
            yield part.column(0), _matrix(part.column(1))


def assign(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""

    def run(batches):
        for ids, vectors in _batches(batches):
            cluster, distance, _ = nearest(vectors, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    return whole.mapInArrow(run, ASSIGNED.format(id=whole.schema["id"].dataType.simpleString()))


def moved(whole: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floor of the mean, empty clusters as they were."""
    k, width = centroids.shape

    def run(batches):
        # Python numbers, so no sum overflows
        sums, counts = np.zeros((k, width), object), np.zeros(k, object)
        for _, vectors in _batches(batches):
            cluster, _, _ = nearest(vectors, centroids)
            part = np.zeros((k, width), np.int64)
            np.add.at(part, cluster, vectors)
            sums, counts = sums + part.astype(object), counts + np.bincount(cluster, minlength=k).astype(object)
        for c in range(k):
            if counts[c]:
                yield pa.RecordBatch.from_pydict({
                    "cluster": pa.array([c] * width, pa.int32()), "d": pa.array(range(width), pa.int32()),
                    "total": pa.array([str(x) for x in sums[c]]), "n": pa.array([int(counts[c])] * width, pa.int64())})

    parts = whole.mapInArrow(run, "cluster int, d int, total string, n long")
    rows = parts.groupBy("cluster", "d").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for r in rows:  # at most k * width rows
        out[r["cluster"], r["d"]] = int(r["total"]) // r["n"]
    return out


def fit(whole: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> np.ndarray:
    centroids = start_centroids(whole, k, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(whole, centroids)
    return centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def decide(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    whole = whole_vectors(vectors, id_col, vector_col, dimensions)
    centroids = fit(whole, k, rounds, dimensions)
    assigned = cut_lineage(assign(whole, centroids))
    marks = vectors.sparkSession.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # one row per cluster, at most k
    whole_sum = F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0)))
    facts = sums.withColumn("inertia", whole_sum).join(marks, "cluster")
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
