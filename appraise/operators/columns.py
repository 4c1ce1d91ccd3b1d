"""Projections and derived columns: renames, drops, positional and typed selections, casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.functions.hashing import keyed_hash

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Bulk rename by a ``{old: new}`` map; names the table lacks are ignored."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    """R ``colnames(df) <- names`` (by position)."""
    return df.toDF(*names)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by name list; absent names are ignored."""
    return df.drop(*[c for c in names if c in df.columns])


def drop_positional(df: DataFrame, positions: Iterable[int] = (0,)) -> DataFrame:
    """R ``df[, -1]``: drop columns by 0-based position."""
    pos = set(positions)
    return df.select(*[F.col(c) for i, c in enumerate(df.columns) if i not in pos])


def common_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """R ``select(intersect(names(a), names(b)))``: a's columns that b also has, in a's order."""
    keep = set(other.columns)
    return df.select(*[c for c in df.columns if c in keep])


def numeric_columns(df: DataFrame) -> DataFrame:
    """R ``select_if(df, is.numeric)``."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)])


def cast_to_schema(df: DataFrame, schema: T.StructType, tolerant: bool = True) -> DataFrame:
    """Give every column its declared type (what the reference got by a CSV write/read
    round trip). ``tolerant`` uses ``try_cast``: unparsable text becomes NULL, as R does."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        cols.append((c.try_cast(f.dataType) if tolerant else c.cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def with_date_parts(df: DataFrame, date_col: str, drop: bool = True) -> DataFrame:
    """year and month of a date, then drop the date."""
    out = df.withColumns({"year": F.year(date_col).cast("int"), "month": F.month(date_col).cast("int")})
    return out.drop(date_col) if drop else out


def scale_by(df: DataFrame, names: Iterable[str], divisor: float) -> DataFrame:
    """Divide columns by a constant (coordinates in 1e-6 degrees → degrees)."""
    return df.withColumns({c: F.col(c) / F.lit(float(divisor)) for c in names if c in df.columns})


def random_category(id_col: str, levels: int, salt: str = "category", start: int = 1):
    """R ``sample(1:k, n, replace=TRUE)`` per row, repeatable: ``start + h(salt, id) mod k``."""
    return (F.lit(start) + keyed_hash(salt, id_col) % F.lit(levels)).cast("int")


def id_text(c) -> "F.Column":
    """Ids as plain digits (never ``1.2E7``): integral values printed through BIGINT."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("bigint").cast("string")
