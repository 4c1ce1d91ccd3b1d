"""Scoring output: per-month predictions into a wide table, repeated and aliased columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Submission months of the reference: code = month + 12 * (year - 2016), label = yyyymm
SUBMISSION_MONTHS = [(10, "201610"), (11, "201611"), (12, "201612"), (22, "201710"), (23, "201711"), (24, "201712")]


def pivot_months(long: DataFrame, id_col: str, label_col: str, value_col: str, labels: Sequence[str]) -> DataFrame:
    """Long (id, label, value) → wide (id, one column per label). The label list is given, so
    Spark does not scan for it; one row per id (``first`` of a unique value)."""
    return long.groupBy(id_col).pivot(label_col, list(labels)).agg(F.first(value_col))


def score_months(model, rows: DataFrame, id_col: str, months: Sequence[tuple[int, str]] = SUBMISSION_MONTHS,
                 month_col: str = "month", pred_col: str = "prediction", digits: int | None = 4) -> DataFrame:
    """``makePrediction``: each month is a literal beside the row's own columns, the model is
    applied once per month, and its prediction becomes that month's column: one scan, no shuffle.
    Rounded half to even, as R does; ``digits=None`` leaves predictions as they are."""
    keep = [c for c in rows.columns if c != month_col]
    for code, label in months:
        scored = model.transform(rows.withColumn(month_col, F.lit(code)))
        pred = F.bround(F.col(pred_col), digits) if digits is not None else F.col(pred_col)
        keep.append(label)
        rows = scored.withColumn(label, pred).select(*keep)
    return rows.select(id_col, *[label for _, label in months])


def repeat_columns(df: DataFrame, id_col: str, value_col: str, labels: Sequence[str]) -> DataFrame:
    """One prediction copied into every month column."""
    return df.select(id_col, *[F.col(value_col).alias(lbl) for lbl in labels])


def alias_months(df: DataFrame, id_col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Final header: ``{new: existing}`` (2017 columns reuse the 2016 ones), in mapping order."""
    return df.select(id_col, *[F.col(src).alias(new) for new, src in mapping.items()])
