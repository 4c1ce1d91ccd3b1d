"""Order-independent numeric aggregates.

A double ``sum``/``avg`` depends on the order rows are added, so it can change with the
partitioning or after a task re-runs on another executor. Values that carry a fixed
number of decimals (money in cents, a target rounded to 1e-6) can be summed exactly as
BIGINT units instead; the mean is then ``units / n / 10^digits``, the same on every run
and in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_units(c, digits: int) -> Column:
    """The value in integer units of 10^-digits (exact for values that carry ``digits`` decimals)."""
    return F.rint(_col(c) * F.lit(float(10 ** digits))).cast("bigint")


def fixed_sum(c, digits: int) -> Column:
    return F.sum(fixed_units(c, digits))


def fixed_mean(c, digits: int) -> Column:
    """Exact-sum mean of a fixed-decimal column (NULLs ignored, NULL when there is no value)."""
    x = _col(c)
    return fixed_sum(x, digits) / F.count(x) / F.lit(float(10 ** digits))
