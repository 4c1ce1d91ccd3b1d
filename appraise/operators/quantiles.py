"""Exact sample quantiles (R ``quantile`` type 7 = DuckDB ``quantile_cont`` = Spark ``percentile``),
computed without sending the whole column through one task.

Spark's exact ``percentile`` aggregate keeps a map of every distinct value and merges
it in a single task, so its memory grows with the column. Here the order statistics
are found by narrowing instead:

1. ``count`` the non-missing values; the type-7 quantile at p needs the values at
   0-based ranks ``floor((n-1)p)`` and the next one.
2. While the open interval that holds a wanted rank has more than ``window_rows`` values, ask
   ``percentile_approx`` (a mergeable sketch, distributed) for values just below and above the rank
   inside the interval, and count exactly how many values lie below and at each of the two.
   A rank inside a candidate's ties is found; else the rank lies below, between or above
   the candidates, and that open interval, which holds neither of them, is the next one. So every
   round removes at least one distinct value, a heavy value ends the search for every rank
   in its ties at once, and the interval shrinks by about ``accuracy / 4`` otherwise. Whatever
   the sketch says, the counts keep the answer exact.
3. Group the values inside the final intervals in one job; that table has at most
   ``len(ranks) * window_rows`` rows, so it is fetched and its counts are walked.

At n = 10^12 and the defaults this is about five scans; at test scale it is one scan
plus the grouped pick.
"""

from __future__ import annotations

import math

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _interval(v, lo, hi):
    """``v`` strictly between the bounds (None: unbounded)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (v > F.lit(lo))
    if hi is not None:
        cond = cond & (v < F.lit(hi))
    return cond


def exact_order_stats(values: DataFrame, ranks: list[int], n: int, *, window_rows: int = 100_000,
                      accuracy: int = 10_000, seeds: dict | None = None) -> dict[int, float]:
    """Values at the given 0-based ranks of the single double column ``_v`` (no NULLs).
    ``seeds``: candidate (low, high) values per rank from an earlier sketch (skips one pass)."""
    v = F.col("_v")
    out: dict[int, float] = {}
    # rank -> (lo, hi, below, inside): the open interval holds ranks below .. below+inside-1
    state = {r: (None, None, 0, n) for r in sorted(set(ranks))}
    margin = 2.0 / accuracy
    while pending := [r for r, s in state.items() if r not in out and s[3] > window_rows]:
        if seeds is not None and all(r in seeds for r in pending):
            cand, seeds = {r: seeds[r] for r in pending}, None
        else:
            # one sketch per distinct interval (in the first round every rank shares the full range)
            groups: dict[tuple, list[int]] = {}
            for r in pending:
                groups.setdefault(state[r][:2], []).append(r)
            aggs, wanted = [], {}
            for gi, ((lo, hi), rs) in enumerate(groups.items()):
                fracs = []
                for r in rs:
                    f = (r - state[r][2]) / state[r][3]
                    wanted[r] = (gi, len(fracs))
                    fracs += [max(0.0, f - margin), min(1.0, f + margin)]
                aggs.append(F.percentile_approx(F.when(_interval(v, lo, hi), v), fracs, accuracy).alias(f"q{gi}"))
            approx = values.agg(*aggs).first()
            cand = {r: (approx[f"q{gi}"][j], approx[f"q{gi}"][j + 1]) for r, (gi, j) in wanted.items()}
        points = sorted({x for pair in cand.values() for x in pair})
        counts = [c for i, x in enumerate(points) for c in (F.count_if(v < F.lit(x)).alias(f"b{i}"), F.count_if(v == F.lit(x)).alias(f"e{i}"))]
        exact = values.agg(*counts).first()
        at = {x: (exact[f"b{i}"], exact[f"e{i}"]) for i, x in enumerate(points)}
        for r in pending:
            # every point counted this round may narrow the interval, not only the rank's own two
            lo, hi, below, inside = state[r]
            top = below + inside
            for x in points:
                b, e = at[x]
                if b <= r < b + e:
                    out[r] = float(x)
                    break
                if b + e <= r and b + e > below:
                    lo, below = x, b + e
                elif r < b and b < top:
                    hi, top = x, b
            state[r] = (lo, hi, below, top - below)
    # final pick: all open intervals in ONE grouped job; its rows are distinct values inside the
    # intervals, at most sum(inside) <= len(ranks) * window_rows, so fetching them is bounded
    open_ranks = [r for r in state if r not in out]
    if open_ranks:
        intervals = sorted({state[r][:2] for r in open_ranks}, key=str)
        cond = F.lit(False)
        for lo, hi in intervals:
            cond = cond | _interval(v, lo, hi)
        fetched = values.where(cond).groupBy("_v").agg(F.count(F.lit(1)).alias("_c")).collect()
        vals = np.array([row[0] for row in fetched], dtype=float)
        cnts = np.array([row[1] for row in fetched], dtype=np.int64)
        order = np.argsort(vals, kind="stable")
        vals, cnts = vals[order], cnts[order]
        for r in open_ranks:
            lo, hi, below, _inside = state[r]
            keep = np.ones(len(vals), dtype=bool)
            if lo is not None:
                keep &= (vals > lo) | np.isnan(vals)  # NaN sorts last, as in Spark
            if hi is not None:
                keep &= (vals < hi) | (np.isnan(hi) & ~np.isnan(vals))
            v_in, ends = vals[keep], np.cumsum(cnts[keep])
            out[r] = float(v_in[int(np.searchsorted(ends, r - below, side="right"))])
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float], *, window_rows: int = 100_000,
                    accuracy: int = 10_000, n: int | None = None) -> list[float | None]:
    """Type-7 quantiles of ``col`` (NULLs ignored), exact, as python floats (driver-side scalars).
    ``n`` = number of non-missing values when the caller already has it (saves one pass)."""
    return quantiles_and_counts(df, col, probs, window_rows=window_rows, accuracy=accuracy, n=n)[0]


def quantiles_and_counts(df: DataFrame, col: str, probs: list[float], *, window_rows: int = 100_000,
                         accuracy: int = 10_000, n: int | None = None) -> tuple[list[float | None], int, int | None]:
    """``exact_quantiles`` plus (rows present, all rows). Without ``n`` the first pass counts
    both and takes the first sketch at the same time."""
    values = df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    first_round, total = None, None
    if n is None:
        # all rows, present rows and a first sketch at p +- margin in ONE pass; the sketch is only
        # used when the column is too large to pick from directly
        margin = 2.0 / accuracy
        fracs = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
        x = F.col(col).cast("double")
        row = df.agg(F.count(F.lit(1)).alias("t"), F.count(x).alias("n"),
                     F.percentile_approx(x, fracs, accuracy).alias("q")).first()
        n, total, first_round = int(row["n"]), int(row["t"]), row["q"]
    if n == 0:
        return [None for _ in probs], 0, total
    plan = []
    for p in probs:
        h = (n - 1) * p
        i = int(math.floor(h))
        j = min(i + 1, n - 1)
        plan.append((i, j, h - i))
    ranks = sorted({i for i, _, _ in plan} | {j for _, j, d in plan if d > 0})
    seeds = None
    if first_round is not None and n > window_rows:
        seeds = {}
        for k, (i, j, d) in enumerate(plan):
            for r in (i, j):
                seeds[r] = (first_round[2 * k], first_round[2 * k + 1])
    stats = exact_order_stats(values, ranks, n, window_rows=window_rows, accuracy=accuracy, seeds=seeds)
    result = []
    for i, j, d in plan:
        lo = stats[i]
        result.append(lo if d == 0 else lo + (stats[j] - lo) * d)
    return result, n, total
