"""R-vector semantics as SQL column expressions.

R and SQL disagree on missing values in a few places; each helper states the R rule it
keeps. All helpers return plain ``Column`` expressions (codegen-friendly, no UDF).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def isin_or_false(c, values: Iterable) -> Column:
    """R ``x %in% S``: a missing x gives FALSE (SQL ``IN`` would give NULL)."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def is_whole_between(c, lo: int, hi: int) -> Column:
    """R ``x %in% lo:hi`` for a numeric x: an integer value inside the range (NULL → FALSE)."""
    x = _col(c)
    return F.coalesce(x.between(lo, hi) & (x == F.floor(x)), F.lit(False))


def flag_to_number(c, true_text: str, yes, no) -> Column:
    """R ``ifelse(x == 'true', yes, no)``: a missing x stays missing (SQL CASE would pick ``no``)."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(None)).when(x == F.lit(true_text), F.lit(yes)).otherwise(F.lit(no))


def presence_flag(c) -> Column:
    """R ``ifelse(is.na(x), 0, 1)`` as INT."""
    return _col(c).isNotNull().cast("int")


def sign_label(c) -> Column:
    """R ``ifelse(y <= 0, 0, 1)`` as INT, NULL kept."""
    y = _col(c)
    return F.when(y <= 0, F.lit(0)).when(y > 0, F.lit(1))


def safe_ratio(num, den) -> Column:
    """Ratio feature; R gives Inf/NaN for a zero divisor, we give NULL (ANSI ``/`` would raise)."""
    return F.try_divide(_col(num), _col(den))


def tolerant_number(c, to: str = "double") -> Column:
    """R ``as.numeric(text)``: text that is not a number becomes NULL (a plain cast raises under ANSI)."""
    return _col(c).try_cast(to)


def fill_when_other_present(target, other, value) -> Column:
    """R ``ifelse(is.na(a) & !is.na(b), value, a)``."""
    a, b = _col(target), _col(other)
    return F.when(a.isNull() & b.isNotNull(), F.lit(value)).otherwise(a)


def fill_by_identity(target, total, part) -> Column:
    """R ``ifelse(is.na(a), total - part, a)``."""
    return F.coalesce(_col(target), _col(total) - _col(part))


def merged_flag(count_col, flag_col, true_text: str = "true") -> Column:
    """Three chained R ``ifelse`` on a count and a text flag, as text:
    count present → '1'; else flag == 'true' → '2'; else the flag itself, missing → '0'."""
    n, f = _col(count_col), _col(flag_col)
    return (F.when(n.isNotNull(), F.lit("1"))
            .when(f == F.lit(true_text), F.lit("2"))
            .otherwise(F.coalesce(f.cast("string"), F.lit("0"))))


def collapse_levels(c, lo: int, hi: int, label: str = "other") -> Column:
    """R ``ifelse(x %in% lo:hi, label, x)``: whole numbers in [lo, hi] become ``label``; result is text."""
    x = _col(c)
    return F.when(is_whole_between(x, lo, hi), F.lit(label)).otherwise(x.cast("string"))


def year_month(c) -> tuple[Column, Column]:
    """Year and month of a date or timestamp (INT each)."""
    x = _col(c)
    return F.year(x).cast("int"), F.month(x).cast("int")


def month_code(year_col, month_col, base_year: int = 2016) -> Column:
    """Scoring month code ``month + 12 * (year - base_year)`` (10..12 → 2016, 22..24 → 2017)."""
    return _col(month_col) + F.lit(12) * (_col(year_col) - F.lit(base_year))
