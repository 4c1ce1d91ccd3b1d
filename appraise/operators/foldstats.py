"""Statistics with a fold left out.

Cross-validation needs each statistic (a column's mean and standard deviation, a Box-Cox power, a list of levels) from the
training part of every fold. All of them are sums that merge, so one aggregate by fold gives the parts, and the statistic
without fold f is the merge of the other parts: k folds cost one pass, not k, and no row ever feeds the statistic that
is applied to it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.operators.scale import BOXCOX_GRID


def _merged(parts: list[tuple]) -> tuple:
    """(n, mean, sum of squared deviations) of several parts together."""
    n, mean, m2 = 0, 0.0, 0.0
    for pn, pmean, pm2 in parts:
        if pn:
            d, total = pmean - mean, n + pn
            mean, m2, n = mean + d * pn / total, m2 + pm2 + d * d * n * pn / total, total
    return n, mean, m2


def excluded_moments(df: DataFrame, cols: Sequence[str], fold_col: str = "fold") -> list[tuple]:
    """(fold, column, n, mean, sd) from the rows outside of each fold; n counts present values, the sample sd is None below two."""
    parts = {}
    aggs = [a for c in cols for a in (F.count(c).alias(f"n_{c}"), F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                                      (F.var_pop(F.col(c).cast("double")) * F.count(c)).alias(f"v_{c}"))]
    for r in df.groupBy(fold_col).agg(*aggs).collect():  # one row a fold
        for c in cols:
            parts[r[fold_col], c] = (r[f"n_{c}"], r[f"m_{c}"], r[f"v_{c}"])
    folds = sorted({f for f, _ in parts})
    out = []
    for f in folds:
        for c in cols:
            n, mean, m2 = _merged([parts[g, c] for g in folds if g != f])
            out.append((f, c, n, mean if n else None, math.sqrt(m2 / (n - 1)) if n > 1 else None))
    return out


def excluded_boxcox(df: DataFrame, col: str, fold_col: str = "fold", grid: Sequence[float] = BOXCOX_GRID) -> list[tuple]:
    """(fold, lambda, loglik): the Box-Cox profile from the positive values outside of each fold, two passes for all folds.
    The transform is centred at its value for the geometric mean of all rows, a shift that changes no variance."""
    lx = df.where(F.col(col) > 0).select(fold_col, F.log(F.col(col).cast("double")).alias("_lx"))
    first = lx.groupBy(fold_col).agg(F.count("*").alias("n"), F.sum("_lx").alias("s")).collect()
    n_all = sum(r.n for r in first)
    if not n_all:
        return []
    centre = math.fsum(r.s for r in first) / n_all
    aggs = []
    for i, lam in enumerate(grid):
        d = F.col("_lx") - centre if lam == 0 else (F.exp(F.col("_lx") * float(lam)) - math.exp(lam * centre)) / float(lam)
        aggs += [F.sum(d).alias(f"s{i}"), F.sum(d * d).alias(f"q{i}")]
    moments = {r[fold_col]: r for r in lx.groupBy(fold_col).agg(*aggs).collect()}
    out = []
    for f in sorted(moments):
        others = [r for r in first if r[fold_col] != f]
        n, sl = sum(r.n for r in others), math.fsum(r.s for r in others)
        for i, lam in enumerate(grid):
            s1, s2 = (math.fsum(m[f"{a}{i}"] for g, m in moments.items() if g != f) for a in "sq")
            var = (s2 - s1 * s1 / n) / n if n else 0.0
            out.append((f, float(lam), -0.5 * n * math.log(var) + (lam - 1.0) * sl if var > 0 else None))
    return out


def excluded_levels(df: DataFrame, col: str, fold_col: str = "fold") -> DataFrame:
    """(fold, level) for every level of ``col`` that some row outside of the fold has; missing is no level. A level's folds
    are one aggregate; a level that only fold f has is left out of f alone."""
    folds = df.select(fold_col).distinct().agg(F.array_sort(F.collect_set(fold_col)).alias("all")).first()["all"]
    have = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("level")).agg(F.collect_set(fold_col).alias("has"))
    every = F.array(*[F.lit(f) for f in folds]) if folds else F.array().cast("array<int>")
    return have.select("level", F.explode(F.filter(every, lambda f: F.size(F.array_except("has", F.array(f))) > 0)).alias("fold")).select("fold", "level")


def excluded_fill(df: DataFrame, cols: Sequence[str], fold_col: str = "fold") -> DataFrame:
    """Every row's gaps filled by the mean of the rows outside of its own fold (what the model that will score it has seen)."""
    means = {(f, c): m for f, c, _n, m, _sd in excluded_moments(df, cols, fold_col)}
    out = {}
    for c in cols:
        fill = F.lit(None).cast("double")
        for (f, name), m in means.items():
            if name == c and m is not None:
                fill = F.when(F.col(fold_col) == f, F.lit(m)).otherwise(fill)
        out[c] = F.coalesce(F.col(c).cast("double"), fill)
    return df.withColumns(out)
