import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from appraise.llm import centroids


def brute(rows, k, rounds, dim, scale=1024):
    """Plain clustering of (vec_id, vector): {row index: (cluster, distance)}, final centroids."""
    kept = [(i, v, [math.floor(float(c) * scale) for c in x]) for i, (v, x) in enumerate(rows)
            if x is not None and len(x) == dim and all(c is not None and math.isfinite(c) for c in x)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[1] is None else r[1]}".encode()).hexdigest(), r[2]))
    mid = [list(r[2]) for r in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, m)), c) for c, m in enumerate(mid))
    for _ in range(rounds):
        own = [near(x)[1] for _, _, x in kept]
        for c in range(len(mid)):
            mine = [x for (_, _, x), o in zip(kept, own) if o == c]
            if mine:
                mid[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return [(v, *near(x)[::-1]) for _, v, x in kept], mid


def vectors(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    middle = [[rng.uniform(-3, 3) for _ in range(dim)] for _ in range(5)]
    return [(i, [float(np.float32(m + rng.gauss(0, spread))) for m in rng.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("n,dim,k", [(400, 64, 8), (300, 3, 8), (200, 1, 5), (40, 2, 8)])
def test_equals_plain_clustering(spark, n, dim, k):
    rows = vectors(n, dim, n)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found, mid = centroids.cluster(df, k=k, rounds=6, dim=dim)
    want, centre = brute(rows, k, 6, dim)
    assert mid.tolist() == centre
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_walk_ends_early_and_ties_take_the_smaller_number():
    rng = np.random.default_rng(3)
    mid = rng.integers(-100_000, 100_000, (64, 2))
    x = rng.integers(-100_000, 100_000, (2000, 2))
    who, far, reads = centroids.nearest(x, mid)
    all_far = ((x[:, None, :] - mid[None]) ** 2).sum(axis=2)
    assert (who == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
    assert reads < 0.6 * 2000 * 2 * 64
    mid = np.array([[2, 2], [0, 0], [2, 2], [4, 4], [0, 4]])
    x = np.array([[2, 2], [1, 1], [3, 3], [2, 4], [100, 100], [0, 2]])
    all_far = ((x[:, None, :] - mid[None]) ** 2).sum(axis=2)
    assert centroids.nearest(x, mid)[0].tolist() == all_far.argmin(axis=1).tolist()
    assert [len(a) for a in centroids.nearest(x[:0], mid)[:2]] == [0, 0]


def test_odd_vectors_copies_and_clashing_names(spark):
    good = vectors(60, 64, 9)
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, []), (102, [0.0] * 63), (103, [0.0] * 65), (104, [nan] + [0.0] * 63), (105, [inf] + [0.0] * 63), (106, [-inf] + [0.0] * 63),
           (None, good[0][1]), (7, good[7][1]), (7, good[8][1]), (8, [-0.5 / 1024] * 64)]
    rows = good + odd + [(107, [None] + [0.0] * 63)]
    df = spark.createDataFrame([(v, x, 1, "h", 2.0) for v, x in rows], "vec_id long, embedding array<float>, cluster int, x string, distance double")
    got = centroids.report(df)
    want, mid = brute(rows, 8, 10, 64)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got.collect()), key=str) == sorted(want, key=str)
    one = got.groupBy("cluster").agg(F.sum("distance").alias("s"), F.min("cluster_inertia").alias("i"), F.min("centroid_sha256").alias("h"), F.min("inertia").alias("t"))
    for r in one.collect():
        assert r.s == r.i and r.t == sum(w[2] for w in want)
        assert r.h == hashlib.sha256(",".join(map(str, mid[r.cluster])).encode()).hexdigest()


def test_empty_table_few_vectors_and_far_components(spark):
    kind = "vec_id long, embedding array<float>"
    assert centroids.report(spark.createDataFrame([], kind)).collect() == []
    few = vectors(3, 64, 1)
    assert sorted(r.distance for r in centroids.report(spark.createDataFrame(few, kind)).collect()) == [0, 0, 0]
    with pytest.raises(Exception, match="a component times 1024 is beyond"):
        centroids.report(spark.createDataFrame([(1, [1e30] * 64)], kind)).collect()
