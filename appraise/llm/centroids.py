"""Centroid clustering by the threshold algorithm.

Vectors of integers are assigned to the nearest of a few centroids, the centroids move to the floored means, and so
on for a fixed number of rounds. The search for the nearest centroid walks, in every dimension, the list of the
centroids sorted by that component outward from the vector's own value. A centroid that is met gets its exact squared
distance; a centroid that no list has met yet is at least as far as the frontier in every dimension, so the walk ends
once the sum of the squared frontier distances strictly exceeds the best exact distance (strictly, since an unmet
centroid at the same distance may have the smaller number).

Spark holds the vectors: they are written once as integers, every round is one scan of that table whose tasks
return k rows of sums, and a round's state is k centroids on the driver. Sums are exact at any number of rows.

Defined results: vectors that are null, have another number of components, or hold a null or non-finite component are left out;
a row is a vector, so rows of equal vec_id are vectors of their own (equal hashes are taken in the order of their
components); a null vec_id hashes as the empty text; with fewer kept vectors than k, each of them starts a centroid;
an empty table gives an empty result; columns other than vec_id and the vector are ignored, whatever their names.
A component beyond ``limit(dim)`` in size, for which squared distances do not fit 64 bits, ends the job with that message.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm import tables

K, DIM, ROUNDS, SCALE = 8, 64, 10, 1024
#: Vectors that numpy works on at once.
CHUNK = 4096
_FAR = np.int64(1) << np.int64(62)


def limit(dim: int) -> int:
    """The largest size of an integer component for which ``dim`` squared differences sum to less than 2^62."""
    return 1 << ((62 - max(dim - 1, 1).bit_length()) // 2 - 1)


def integers(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of long) of the vectors that are kept."""
    x = F.col(vector).cast("array<double>")
    far = F.raise_error(F.lit(f"a component times {scale} is beyond {limit(dim)}")).cast("long")
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
            .where((F.size("x") == dim) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
            .select("vec_id", F.transform("x", lambda v: F.when(F.abs(v * scale) <= limit(dim), F.floor(v * scale)).otherwise(far)).alias("x")))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of the nearest centroid of each row of ``x`` and its squared distance (equal distances: the smaller
    number), and how many list entries were read in all."""
    k, dims = centroids.shape
    by_value = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, by_value, axis=0)
    each = np.arange(dims)
    best, who = np.full(len(x), _FAR), np.full(len(x), k)
    met = np.zeros((len(x), k), bool)
    rows = np.arange(len(x))
    up = np.stack([np.searchsorted(values[:, j], x[:, j]) for j in range(dims)], axis=1) if len(x) else np.zeros((0, dims), np.int64)
    down = up - 1
    reads = 0
    for _ in range(k):
        own = x[rows]
        below = np.where(down >= 0, own - values[np.maximum(down, 0), each], _FAR)
        above = np.where(up < k, values[np.minimum(up, k - 1), each] - own, _FAR)
        lower = below <= above
        gap = np.minimum(below, above)
        entry = by_value[np.where(lower, down, up), each]
        reads += entry.size
        down, up = down - lower, up + ~lower
        now = np.zeros((len(rows), k), bool)
        now[np.arange(len(rows))[:, None], entry] = True
        now &= ~met[rows]
        met[rows] |= now
        for c in range(k):
            new = np.flatnonzero(now[:, c])
            far = ((own[new] - centroids[c]) ** 2).sum(axis=1)
            at = rows[new]
            nearer = (far < best[at]) | ((far == best[at]) & (c < who[at]))
            best[at[nearer]], who[at[nearer]] = far[nearer], c
        going = (gap * gap).sum(axis=1) <= best[rows]
        rows, up, down = rows[going], up[going], down[going]
        if not len(rows):
            break
    return who, best, reads


def _pieces(batches, at: int):
    for batch in batches:
        x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        for lo in range(0, batch.num_rows, CHUNK):
            yield batch.slice(lo, CHUNK), x[lo:lo + CHUNK]


def move(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over ``vectors`` (vec_id, x): exact floored means; an empty one stays."""
    k, dims = centroids.shape

    def run(batches):
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x in _pieces(batches, 0):
            who = nearest(x, centroids)[0]
            for c in np.unique(who).tolist():
                total[c] += x[who == c].sum(axis=0)
            count += np.bincount(who, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]),
                                          pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    sums = vectors.select("x").mapInArrow(run, "cluster int, n long, total array<long>")
    wide = [F.sum(F.col("total")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]
    out = centroids.copy()
    for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():  # k rows
        out[r.cluster] = [int(r[f"s{d}"]) // r.n for d in range(dims)]
    return out


def start(vectors: DataFrame, k: int = K, salt: str = "3:") -> np.ndarray:
    """The k vectors of smallest SHA-256 of salt + vec_id, in that order."""
    h = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r.x for r in vectors.select(h.alias("h"), "x").orderBy("h", "x").limit(k).collect()], np.int64)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, id_col: str = "vec_id", vector: str = "embedding", dim: int = DIM,
            scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, written, and the final centroids."""
    x = tables.written(integers(vectors, id_col, vector, dim, scale), "vectors")
    centroids = start(x, k)
    for _ in range(rounds if len(centroids) else 0):
        moved = move(x, centroids)
        if np.array_equal(moved, centroids):  # every further round would give the same
            break
        centroids = moved

    def run(batches):
        for batch, own in _pieces(batches, 1):
            who, far, _ = nearest(own, centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(who.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    return tables.written(x.select("vec_id", "x").mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters"), centroids


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    found, centroids = cluster(vectors)
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()]
    about = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    text = [f"""WITH raw AS (SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings),
kept AS MATERIALIZED (SELECT r, vec_id, list_transform(e, lambda v: floor(v::DOUBLE * {SCALE})::BIGINT) AS v FROM raw
  WHERE len(e) = {DIM} AND len(list_filter(e, lambda v: v IS NOT NULL AND isfinite(v))) = {DIM}),
x AS MATERIALIZED (SELECT r, unnest(range(1, {DIM + 1})) AS d, unnest(v) AS x FROM kept),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, d, x FROM first JOIN x USING (r) WHERE c < {K})"""]
    for i in range(ROUNDS + 1):
        text.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, dist * {K} + c) AS c, min(dist) AS dist FROM
  (SELECT x.r, m.c, sum((x.x - m.x) * (x.x - m.x)) AS dist FROM x JOIN c{i} m USING (d) GROUP BY ALL) GROUP BY r)""")
        if i < ROUNDS:
            text.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.c, o.d, CASE WHEN n IS NULL THEN o.x ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS x
  FROM c{i} o LEFT JOIN (SELECT c, d, sum(x) AS s, count(*) AS n FROM x JOIN a{i} USING (r) GROUP BY ALL) USING (c, d))""")
    return ",\n".join(text) + f"""
SELECT vec_id, c::INTEGER AS cluster, dist::BIGINT AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(dist) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS h FROM c{ROUNDS} GROUP BY c) USING (c)"""


ORACLE = _oracle()
