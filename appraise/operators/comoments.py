"""All pairs of many columns at once: co-moment matrix, moments of groups that merge and refill, and patterns of missing cells."""

from __future__ import annotations

from collections.abc import Sequence

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose products are summed at once.
CHUNK = 8192


def comoments(df: DataFrame, cols: Sequence[str]) -> dict[str, np.ndarray]:
    """Pairwise complete sums for every pair (i, j) of numeric columns in one scan: ``n`` (rows with both), ``mean`` (of i where j is
    present too), ``m2`` (squared deviations of i there), ``c`` (co-deviations). A task keeps one block of
    columns x columns matrices, merged chunk by chunk around the chunk's own means, so large offsets cost no digits; the
    blocks merge in the same way in a tree of tasks, and one block reaches the driver."""
    k = len(cols)

    def merge(x, y):
        n = x[0] + y[0]
        with np.errstate(invalid="ignore", divide="ignore"):
            d = y[1] - x[1]
            w = np.where(n > 0, x[0] * y[0] / n, 0.0)
            mean = np.where(n > 0, x[1] + d * np.where(n > 0, y[0] / n, 0.0), 0.0)
        return np.stack([n, mean, x[2] + y[2] + d * d * w, x[3] + y[3] + d * d.T * w])

    def chunk(x):
        there = np.isfinite(x)
        p, z = there.astype(float), np.where(there, x, 0.0)
        shift = np.divide(z.sum(axis=0), np.maximum(p.sum(axis=0), 1))  # sums around the chunk's means
        z = np.where(there, x - shift, 0.0)
        n = p.T @ p
        total, square, cross = z.T @ p, (z * z).T @ p, z.T @ z
        safe = np.maximum(n, 1)
        return np.stack([n, np.where(n > 0, total / safe + shift[:, None], 0.0), square - total * total / safe, cross - total * total.T / safe])

    def blocks(batches):
        held = np.zeros((4, k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            for lo in range(0, len(x), CHUNK):
                held = merge(held, chunk(x[lo:lo + CHUNK]))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([held.ravel().tolist()], pa.list_(pa.float64()))], ["part", "block"])

    def merged(batches):
        held = np.zeros((4, k, k))
        for batch in batches:
            for block in batch.column("block").to_pylist():
                held = merge(held, np.array(block).reshape(4, k, k))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([held.ravel().tolist()], pa.list_(pa.float64()))], ["part", "block"])

    schema = "part long, block array<double>"
    # NaN is missing here, as in the reference's correlation of complete pairs
    level = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(blocks, schema)
    level = level.repartition(32).mapInArrow(merged, schema).coalesce(1).mapInArrow(merged, schema)
    n, mean, m2, c = np.array(level.first().block).reshape(4, k, k)
    return {"n": n.astype(np.int64), "mean": mean, "m2": m2, "c": c}


@dataclass
class Moments:
    """Rows, column means and co-deviations (columns x columns) of a group of rows; ``gaps`` are the columns that it misses."""
    n: int
    mean: np.ndarray
    scatter: np.ndarray
    gaps: tuple[int, ...] = ()


def group_moments(df: DataFrame, cols: Sequence[str], by: Sequence[str], gaps: Sequence[str] = ()) -> list[tuple[tuple, Moments]]:
    """(key, moments) for every group of ``by`` and of cells missing (NULL or NaN) in ``gaps``, in one aggregate whose groups, and not
    rows, reach the driver. Any other missing or infinite cell is an error, as it is for an MLlib fit."""
    k = len(cols)
    x = [F.col(c).cast("double") for c in cols]
    empty = [x[i].isNull() | F.isnan(x[i]) for i in range(k)]
    own = [F.when(~empty[i], x[i]) if c in gaps else x[i] for i, c in enumerate(cols)]
    bad = F.lit(False)
    for i, c in enumerate(cols):
        bad = bad | (F.abs(x[i]) == float("inf")) | (F.lit(False) if c in gaps else empty[i])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    marks = {f"_gap{i}": empty[i] for i, c in enumerate(cols) if c in gaps}
    rows = df.select(*by, *[e.alias(m) for m, e in marks.items()], *[o.alias(f"_c{i}") for i, o in enumerate(own)], F.coalesce(bad, F.lit(False)).alias("_bad"))
    got = rows.groupBy(*by, *marks).agg(
        F.count("*").alias("_n"), F.count_if("_bad").alias("_bad"), *[F.avg(f"_c{i}").alias(f"_m{i}") for i in range(k)],
        *[F.covar_pop(f"_c{i}", f"_c{j}").alias(f"_s{i}_{j}") for i, j in pairs]).collect()
    out = []
    for r in got:
        if r["_bad"]:
            raise ValueError(f"{r['_bad']} rows with a missing or infinite cell in {', '.join(c for c in cols)}")
        mean = np.array([0.0 if r[f"_m{i}"] is None else r[f"_m{i}"] for i in range(k)])
        scatter = np.zeros((k, k))
        for i, j in pairs:
            scatter[i, j] = scatter[j, i] = (r[f"_s{i}_{j}"] or 0.0) * r["_n"]
        out.append((tuple(r[c] for c in by), Moments(r["_n"], mean, scatter, tuple(int(m[4:]) for m in marks if r[m]))))
    return out


def observed_mean(parts: Sequence[Moments], col: int) -> float:
    """The mean of a column over the rows that have it."""
    there = [p for p in parts if col not in p.gaps]
    n = sum(p.n for p in there)
    if not n:
        raise ValueError("no row has a value to take the mean of")
    return float(sum(p.n * p.mean[col] for p in there) / n)


def merge_moments(parts: Sequence[Moments], fills: dict[int, float]) -> Moments:
    """The moments of all rows together once each gap holds its column's fill."""
    n = sum(p.n for p in parts)
    means = []
    for p in parts:
        mean = p.mean.copy()
        for i in p.gaps:
            mean[i] = fills[i]
        means.append(mean)  # a constant has no co-deviation: the scatter of a gap is zero already
    mean = sum(p.n * m for p, m in zip(parts, means)) / n
    scatter = sum(p.scatter + p.n * np.outer(m - mean, m - mean) for p, m in zip(parts, means))
    return Moments(n, mean, scatter)


def rows_of_moments(m: Moments) -> list[tuple[float, np.ndarray]]:
    """(weight, row): two weighted rows for each column with these moments, so that a fit by least squares on them (penalised or not)
    is the fit on the rows that the moments were taken from."""
    k = len(m.mean)
    sd = np.sqrt(np.diag(m.scatter) / m.n)
    scale = np.where(sd > 0, sd, 1.0)
    size, axes = np.linalg.eigh(m.scatter / m.n / np.outer(scale, scale))  # of the correlations: columns differ in scale
    steps = np.sqrt(k * np.maximum(size, 0.0)) * axes * sd[:, None]
    return [(m.n / (2 * k), m.mean + side * steps[:, i]) for i in range(k) for side in (1.0, -1.0)]


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, n, corr) for every pair of columns a before b: Pearson correlation of their complete pairs, NULL where one is constant there."""
    got, rows = comoments(df, cols), []
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            scale = got["m2"][i, j] * got["m2"][j, i]
            rows.append((a, cols[j], int(got["n"][i, j]), float(got["c"][i, j] / np.sqrt(scale)) if scale > 0 else None))
    return df.sparkSession.createDataFrame(rows, "a string, b string, n long, corr double")


def missing_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(pattern, n): which of ``cols`` are missing, as a text of 0 and 1 in their order, and how many rows have it."""
    return df.select(F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols]).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))


def missingness(patterns: DataFrame, cols: Sequence[str]) -> DataFrame:
    """From a pattern table alone: (column, n_missing, share_missing, same_as), where ``same_as`` is the first column that is missing
    in exactly the same rows (the column itself where none comes earlier)."""
    at = F.posexplode(F.split("pattern", "")).alias("i", "missing")
    # Two columns are missing in the same rows if and only if the patterns that miss them are the same.
    own = patterns.select("n", "pattern", at).where("missing <> ''").groupBy("i").agg(
        F.sum(F.when(F.col("missing") == "1", F.col("n")).otherwise(0)).alias("n_missing"), F.sum("n").alias("rows"),
        F.sum(F.when(F.col("missing") == "1", F.xxhash64("pattern").cast("decimal(38,0)")).otherwise(0)).alias("h1"),
        F.sum(F.when(F.col("missing") == "1", F.xxhash64(F.lit(7), "pattern").cast("decimal(38,0)")).otherwise(0)).alias("h2"))
    first = own.groupBy("n_missing", "h1", "h2").agg(F.min("i").alias("first"))
    name = F.array(*[F.lit(c) for c in cols])
    return own.join(F.broadcast(first), ["n_missing", "h1", "h2"]).select(  # a row for each column
        name[F.col("i")].alias("column"), "n_missing", (F.col("n_missing") / F.col("rows")).alias("share_missing"), name[F.col("first")].alias("same_as"))
