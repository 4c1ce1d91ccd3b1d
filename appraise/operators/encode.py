"""Recoding and encoding: level codes, flags, merged flags, tail-level collapse, one-hot."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def level_codes(df: DataFrame, col: str, out_col: str | None = None, first_code: int | None = None,
                model=None) -> DataFrame:
    """R ``as.factor`` then integer codes: sorted distinct levels → 1..n (byte order).

    ``first_code`` renames the first level (R ``levels(f) = c(-999, 1:77)`` gives the first
    level -999 and the rest 1..n-1). Uses ``StringIndexer(alphabetAsc)``: the level list is
    counted by a distributed aggregate and kept in the model (its size is the number of
    levels, not of rows). Missing values stay missing, and with a passed ``model`` so do values that are none of its levels."""
    out = out_col or col
    src = F.col(col).cast("string")
    tmp = df.withColumn("_level", src)
    if model is None:
        model = StringIndexer(inputCol="_level", outputCol="_code", stringOrderType="alphabetAsc",
                              handleInvalid="keep").fit(tmp.where(F.col("_level").isNotNull()))
    coded = model.transform(tmp)
    code = F.col("_code").cast("int")
    if first_code is None:
        value = code + F.lit(1)
    else:
        value = F.when(code == 0, F.lit(first_code)).otherwise(code)
    known = F.col("_level").isNotNull() & (code < len(model.labels))
    return coded.withColumn(out, F.when(known, value)).drop("_level", "_code")


def level_codes_many(df: DataFrame, specs: dict) -> DataFrame:
    """``level_codes`` for several columns with ONE indexer fit (one pass for all level lists).
    ``specs``: {column: (out_column, first_code or None)}."""
    cols = list(specs)
    tmp = df.withColumns({f"_lv_{c}": F.col(c).cast("string") for c in cols})
    indexer = StringIndexer(inputCols=[f"_lv_{c}" for c in cols], outputCols=[f"_cd_{c}" for c in cols],
                            stringOrderType="alphabetAsc", handleInvalid="keep")
    model = indexer.fit(tmp)  # NULLs are not levels
    coded = model.transform(tmp)
    out = {}
    for c, (out_col, first_code) in specs.items():
        code = F.col(f"_cd_{c}").cast("int")
        value = code + F.lit(1) if first_code is None else F.when(code == 0, F.lit(first_code)).otherwise(code)
        out[out_col] = F.when(F.col(f"_lv_{c}").isNull(), F.lit(None)).otherwise(value)
    return coded.withColumns(out).drop(*[f"_lv_{c}" for c in cols], *[f"_cd_{c}" for c in cols])


def one_hot(df: DataFrame, col: str, prefix: str | None = None, as_columns: bool = True) -> DataFrame:
    """R ``model.matrix(~x)[, -1]``: 0/1 indicator per level, the first level (in sorted
    order) dropped. MLlib drops the *last* index, so levels are indexed in descending order."""
    prefix = prefix or col
    indexer = StringIndexer(inputCol=col, outputCol=f"_{col}_idx", stringOrderType="alphabetDesc")
    encoder = OneHotEncoder(inputCol=f"_{col}_idx", outputCol=f"_{col}_vec", dropLast=True)
    model = Pipeline(stages=[indexer, encoder]).fit(df)
    out = model.transform(df)
    if not as_columns:
        return out.drop(f"_{col}_idx")
    labels = model.stages[0].labels  # descending; the last (= first ascending) is the dropped one
    arr = vector_to_array(F.col(f"_{col}_vec"))
    cols = [arr[i].alias(f"{prefix}_{_clean(lbl)}") for i, lbl in enumerate(labels[:-1])]
    return out.select(*[c for c in df.columns], *cols)


def _clean(label: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(label))
