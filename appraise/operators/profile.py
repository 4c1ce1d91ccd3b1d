"""Profiling: group counts, distinct values, missing counts, ranges, summaries, quality rules, top-k."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.operators.evaluate import correlation
from appraise.operators.orderstats import grouped_quantiles
from appraise.operators.quantiles import exact_quantiles


def group_count_desc(df: DataFrame, cols: Sequence[str], count_col: str = "count") -> DataFrame:
    """``group_by(...) %>% summarise(n()) %>% arrange(desc(n))``; ties by the group columns."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col)).orderBy(F.desc(count_col), *cols)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """R ``unique(x)`` (missing is one value)."""
    return df.select(col).distinct()


def null_profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Missing count per column: one aggregate pass, then an unpivot to (column, n_missing)."""
    cols = list(cols) if cols is not None else df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_missing")


def column_range(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """min and max ignoring missing, per numeric column, as (column, min, max) doubles."""
    cols = list(cols)
    wide = df.agg(*[F.struct(F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
                    for c in cols])
    return wide.unpivot([], cols, "column", "r").select("column", "r.min", "r.max")


def column_summary(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """R ``summary`` plus ``sd``: min, q1, median, mean, q3, max, sd, missing per column.
    Means/sd/min/max in one pass; exact quartiles of all columns together (``grouped_quantiles``)."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max"),
                             F.stddev_samp(x).alias("sd"), F.count_if(x.isNull()).alias("n_missing")).alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot([], cols, "column", "s").select("column", "s.*")
    q = grouped_quantiles(df, cols, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))  # a row for each column
    return long.join(F.broadcast(q), "column", "left").select("column", "min", "q1", "median", "mean", "q3", "max", "sd", "n_missing")


def group_summary(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """R ``summary`` of every column by group: by, column, n, min, q1, median, mean, q3, max; exact quartiles of all columns together."""
    q = grouped_quantiles(df, cols, [0.0, 0.25, 0.5, 0.75, 1.0], by)
    means = df.groupBy(*by).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).unpivot(list(by), list(cols), "column", "mean")
    met = q.alias("q").join(means.alias("m"), [F.col(f"q.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by] + [F.col("q.column") == F.col("m.column")])
    return met.select(*[f"q.{c}" for c in by], "q.column", "n", F.col("q0").alias("min"), F.col("q.q1").alias("q1"), F.col("q2").alias("median"), "mean",
                      F.col("q3").alias("q3"), F.col("q4").alias("max"))


def quantile_table(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """R ``quantile(x, probs)`` as a (p, q) table, exact type 7."""
    qs = exact_quantiles(df, col, list(probs))
    return df.sparkSession.createDataFrame([(float(p), q) for p, q in zip(probs, qs)], "p double, q double")


def column_quality(df: DataFrame, cols: Sequence[str], exact_distinct: bool | None = False) -> DataFrame:
    """Per column: rows, missing count and share, distinct count, sample variance, zero-variance
    flag — one aggregate pass. ``exact_distinct=False`` uses HyperLogLog (``approx_count_distinct``),
    which stays one pass on any size; the exact form (True) makes a copy of each row per column and
    shuffles them; None leaves the distinct count out. A column is constant when its least value is its
    largest, or when it has none."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        x = F.col(c)
        distinct = F.lit(None) if exact_distinct is None else F.count_distinct(x) if exact_distinct else F.approx_count_distinct(x)
        var = F.var_samp(x.cast("double")) if _numeric(df, c) else F.lit(None).cast("double")
        aggs.append(F.struct(F.count_if(x.isNull()).alias("n_missing"), distinct.cast("bigint").alias("n_distinct"),
                             var.alias("variance"), F.min(x).eqNullSafe(F.max(x)).alias("constant")).alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot(["_rows"], list(cols), "column", "s").select("column", F.col("_rows").alias("n_rows"), "s.*")
    return long.withColumns({
        "share_missing": F.col("n_missing") / F.col("n_rows"),
        "zero_variance": F.col("constant"),
    }).drop("constant")


def column_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For every pair of columns, in one aggregate pass: Pearson correlation (numeric pairs) and
    the number of rows where exactly one of the two is missing (0 = same missingness). A pair with a
    constant column has a NULL correlation.
    Returns (a, b, corr, missing_mismatch)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = []
    for a, b in pairs:
        corr = (correlation(F.col(a), F.col(b)) if _numeric(df, a) and _numeric(df, b)
                else F.lit(None).cast("double"))
        mismatch = F.count_if(F.col(a).isNull() != F.col(b).isNull())
        aggs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), corr.alias("corr"),
                             mismatch.alias("missing_mismatch")).alias(f"{a}__{b}"))
    wide = df.agg(*aggs)
    return wide.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "s").select("s.*")


def drop_rules(quality: DataFrame, max_share_missing: float = 0.9) -> DataFrame:
    """Columns to drop from a ``column_quality`` table: mostly missing, or constant."""
    reason = (F.when(F.col("share_missing") > F.lit(max_share_missing), F.lit("missing"))
              .when(F.col("zero_variance"), F.lit("constant")))
    return quality.select("column", reason.alias("reason")).withColumn("drop", F.col("reason").isNotNull())


def topk(df: DataFrame, order_col: str, k: int, tie_cols: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``order_col`` descending (ties by ``tie_cols``). Spark plans this as
    a per-partition top-k and a k-row merge, never a full sort."""
    return df.orderBy(F.desc(order_col), *tie_cols).limit(k)


def _numeric(df: DataFrame, c: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                              T.FloatType, T.DoubleType, T.DecimalType))
