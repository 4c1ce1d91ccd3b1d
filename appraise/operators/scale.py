"""Scaling: z-scores (whole table or training rows only) and Box-Cox."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Box-Cox search grid of the reference's model setup: -2 .. 2 by 0.1 (41 values)
BOXCOX_GRID = [round(-2.0 + 0.1 * i, 1) for i in range(41)]


def column_moments(df: DataFrame, names: Iterable[str], where: Column | None = None) -> dict[str, tuple]:
    """Mean and sample sd per column, one aggregate pass; optional row predicate (training part)."""
    names = list(names)
    src = df.where(where) if where is not None else df
    aggs = []
    for c in names:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    row = src.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in names}


def zscore(df: DataFrame, names: Iterable[str], where: Column | None = None,
           moments: dict[str, tuple] | None = None) -> DataFrame:
    """R ``scale``: (x - mean) / sd with the sample sd (n - 1). With ``where`` the statistics
    come from the matching rows only (training part) and are applied to all rows.
    A zero or undefined sd gives NULL (R gives NaN)."""
    names = [c for c in names if c in df.columns]
    moments = moments or column_moments(df, names, where)
    exprs = {}
    for c in names:
        mean, sd = moments[c]
        exprs[c] = F.try_divide(F.col(c) - F.lit(mean), F.lit(sd if sd else None).cast("double"))
    return df.withColumns(exprs)


def _boxcox_expr(x: Column, lam: float) -> Column:
    return F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - F.lit(1.0)) / F.lit(lam)


def boxcox_profile(df: DataFrame, col: str, grid: list[float] = BOXCOX_GRID) -> DataFrame:
    """Profile log-likelihood of the Box-Cox family (Box & Cox 1964) for each lambda of the
    grid, up to a constant: -n/2 * ln(var_pop(t_lambda)) + (lambda - 1) * sum(ln x), over the
    positive values of ``col``.

    Two aggregate passes, both plain sums (map-side partial aggregation, small codegen):
    (1) n, sum(ln x) and the geometric mean g; (2) for every lambda the first two moments of
    d = t_lambda - t_lambda(g), i.e. the transform centred near its mean, so
    var = (S2 - S1^2 / n) / n has no cancellation. Returns a (lambda, loglik) table."""
    x = F.col(col).cast("double")
    pos = df.where(F.col(col) > 0).select(F.log(x).alias("_lx"))
    first = pos.agg(F.count(F.lit(1)).alias("n"), F.sum("_lx").alias("sl")).first()
    n, sl = int(first["n"]), first["sl"]
    spark = df.sparkSession
    if n == 0:
        return spark.createDataFrame([(float(v), None) for v in grid], "lambda double, loglik double")
    mlog = sl / n
    aggs = []
    for i, lam in enumerate(grid):
        # x^lambda as exp(lambda ln x): one log per row, then one exp per lambda (cheaper than pow)
        if lam == 0:
            d = F.col("_lx") - F.lit(mlog)
        else:
            d = (F.exp(F.lit(float(lam)) * F.col("_lx")) - F.lit(math.exp(lam * mlog))) / F.lit(float(lam))
        aggs += [F.sum(d).alias(f"s{i}"), F.sum(d * d).alias(f"q{i}")]
    mom = pos.agg(*aggs).first()
    rows = []
    for i, lam in enumerate(grid):
        s1, s2 = mom[f"s{i}"], mom[f"q{i}"]
        var = (s2 - s1 * s1 / n) / n
        rows.append((float(lam), -0.5 * n * math.log(var) + (lam - 1.0) * sl if var > 0 else None))
    return spark.createDataFrame(rows, "lambda double, loglik double")


def boxcox_lambda(df: DataFrame, col: str, grid: list[float] = BOXCOX_GRID, fudge: float = 0.2) -> float:
    """Best lambda of the grid; within ``fudge`` of 0 it becomes 0 (log), of 1 it becomes 1."""
    best = boxcox_profile(df, col, grid).orderBy(F.desc("loglik"), F.asc("lambda")).first()["lambda"]
    if abs(best) < fudge:
        return 0.0
    if abs(best - 1.0) < fudge:
        return 1.0
    return float(best)


def boxcox_apply(df: DataFrame, col: str, lam: float | None = None, out_col: str | None = None,
                 center_scale: bool = True) -> DataFrame:
    """Transform ``col`` by Box-Cox with ``lam`` (found when not given), then centre and scale."""
    out = out_col or col
    lam = boxcox_lambda(df, col) if lam is None else lam
    res = df.withColumn(out, F.when(F.col(col) > 0, _boxcox_expr(F.col(col).cast("double"), lam)))
    return zscore(res, [out]) if center_scale else res
