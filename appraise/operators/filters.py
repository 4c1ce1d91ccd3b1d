"""Row filters: quantile trim, membership, incomplete rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.functions.rsem import isin_or_false
from appraise.operators.quantiles import exact_quantiles


def trim_quantiles(df: DataFrame, col: str, lower: float = 0.005, upper: float = 0.995,
                   bounds: tuple[float, float] | None = None) -> DataFrame:
    """Keep rows with ``col`` between its ``lower`` and ``upper`` sample quantiles, ends
    included; a missing value is dropped (R ``%between%`` with ``filter``). The two
    bounds are exact (``exact_quantiles``), then the filter is a plain predicate on the scan."""
    lo, hi = bounds if bounds is not None else exact_quantiles(df, col, [lower, upper])
    if lo is None:
        return df.limit(0)
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def keep_members(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose value is in the set; NULL is not a member."""
    return df.where(isin_or_false(col, values))


def drop_incomplete(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """R ``na.omit``: drop rows with any missing value in ``subset`` (all columns by default)."""
    return df.na.drop(how="any", subset=list(subset) if subset is not None else None)
