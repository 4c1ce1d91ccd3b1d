"""Types of the columns of a text table, inferred from every cell.

A column's type is the join, in the lattice missing < int < bigint < double < text and missing < date < text, of the types of its
cells. The join is an aggregate of a few counts a column, so it merges over any partitioning, needs one scan for all columns
and sees the one bad cell in the last row that a sampled guess would miss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What each inferred type is cast to.
CASTS = {"missing": "string", "int": "int", "bigint": "bigint", "double": "double", "date": "date", "text": "string"}


def _cell(c: str, missing: Sequence[str]) -> tuple[Column, Column]:
    """The cell without blanks around it, and whether it is missing."""
    x = F.btrim(F.col(c).cast("string"))
    return x, x.isNull() | x.isin("", *missing)


def infer(df: DataFrame, cols: Sequence[str] | None = None, missing: Sequence[str] = ()) -> DataFrame:
    """(column, type, n, n_missing, n_int, n_bigint, n_double, n_date): the least type that holds every cell, and how many cells
    each type holds. ``missing`` are further texts that stand for a missing cell, as "NA". A column of dates and numbers is text; so
    is one whose whole numbers pass 64 bits only if some cell is no double either."""
    cols = list(cols if cols is not None else df.columns)
    aggs = []
    for c in cols:
        x, gone = _cell(c, missing)
        # a plain number: no letters (Spark casts "1d" and "Infinity" too), so that the text survives the round trip
        number = ~gone & x.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
        whole = ~gone & x.rlike(r"^[+-]?[0-9]+$")
        day = ~gone & x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & x.try_cast("date").isNotNull()
        aggs.append(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(gone).alias("n_missing"),
                             F.count_if(whole & x.try_cast("int").isNotNull()).alias("n_int"), F.count_if(whole & x.try_cast("bigint").isNotNull()).alias("n_bigint"),
                             F.count_if(number).alias("n_double"), F.count_if(day).alias("n_date")).alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot([], cols, "column", "s").select("column", "s.*")
    present = F.col("n") - F.col("n_missing")
    kind = F.when(present == 0, "missing")
    for name in ("int", "bigint", "double", "date"):
        kind = kind.when(F.col(f"n_{name}") == present, name)
    return long.select("column", kind.otherwise("text").alias("type"), "n", "n_missing", "n_int", "n_bigint", "n_double", "n_date")


def retype(df: DataFrame, missing: Sequence[str] = (), types: dict[str, str] | None = None) -> DataFrame:
    """``df`` (all text) with every column cast to its inferred type (``types``: already inferred), missing texts as NULL."""
    if types is None:
        types = {r.column: r.type for r in infer(df, missing=missing).collect()}  # a row for each column
    out = {}
    for c, kind in types.items():
        x, gone = _cell(c, missing)
        out[c] = F.when(~gone, F.col(c) if kind == "text" else x.cast(CASTS[kind]))
    return df.withColumns(out)
