"""Clustering against whole-number brute force, and the threshold search against all distances."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from shelfline.llm import centroids as C


def by_hand(rows, k=C.CENTROIDS, rounds=C.ROUNDS, width=C.DIMENSIONS):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    centers = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    near = lambda v: min(range(len(centers)), key=lambda j: (far(v, centers[j]), j))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v), []).append(v)
        centers = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centers)]
    found = [(i, near(v), v) for i, v in kept]
    inertia = {}
    for _, j, v in found:
        inertia[j] = inertia.get(j, 0) + far(v, centers[j])
    mark = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((i, j, far(v, centers[j]), inertia[j], sum(inertia.values()), mark(centers[j])) for i, j, v in found)


def test_clusters_equal_brute_force(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, C.decide(df.repartition(5)).collect())) == by_hand(rows)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    base = [(i, rng.normal(0, 1, 4).tolist()) for i in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, None, 1.0, 1.0]), (104, [1.0, float("nan"), 1.0, 1.0]),
           (105, [float("inf"), 1.0, 1.0, 1.0]), (106, base[3][1]), (106, base[3][1]), (107, [-0.001, 0.0, 0.999, -1.0]), (None, base[5][1])]
    frame = lambda data: spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x"))
    data = base + odd[:-1]
    assert sorted(map(tuple, C.decide(frame(data), dimensions=4, k=5).collect())) == by_hand(data, k=5, width=4)
    assert C.decide(frame(data + odd[-1:]), dimensions=4).where("vec_id is null").count() == 1
    # fewer vectors than centroids, equal ones among them
    few = [(1, [1.0, 1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.0, 1.0]), (3, [0.0, 0.0, 0.0, 0.0])]
    assert sorted(map(tuple, C.decide(frame(few), dimensions=4).collect())) == by_hand(few, width=4)
    assert C.decide(frame([]), dimensions=4).count() == 0
    # a distance that no long holds
    assert C.decide(frame([(1, [1e30, 0.0, 0.0, 0.0])]), dimensions=4).count() == 0


def test_the_search_is_exact_and_stops_early():
    rng = np.random.default_rng(1)
    for n, k, width, size in ((400, 16, 64, 30), (300, 7, 3, 4), (50, 1, 5, 3), (200, 16, 2, 2), (200, 16, 1, 500)):
        v, c = rng.integers(-size, size, (n, width)), rng.integers(-size, size, (k, width))
        d = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        cluster, distance, taken = C.nearest(v, c)
        assert (cluster == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all() and (taken <= k).all()
        if width == 1:
            assert taken.mean() < k / 3
