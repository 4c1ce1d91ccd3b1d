"""Level codes and indicators for columns of any number of levels.

The levels of a column are its distinct values, ranked in byte order: the distinct levels (never the rows) are sorted over
range partitions, a partition's levels are numbered from the number of levels in the partitions before it, and codes are joined back.
Levels stay in a table: the driver sees one count a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.operators.joins import broadcast_small
from appraise.sources import io

#: Dictionaries of at most this many levels are broadcast to the rows; larger ones are joined by shuffle.
BROADCAST_LEVELS = 100_000


def level_dictionary(df: DataFrame, col: str) -> DataFrame:
    """(level, code): the distinct present values of ``col`` as text, numbered from 1 in byte order."""
    levels = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("level")).distinct()
    parts = io.checkpoint_table(levels.repartitionByRange("level").sortWithinPartitions("level").withColumn("_part", F.spark_partition_id()), "levels")
    begin, before = {}, 0
    for r in sorted(parts.groupBy("_part").agg(F.count("*").alias("n")).collect()):  # a row for each range partition
        begin[r._part], before = before, before + r.n

    def number(batches):
        seen = {}
        for batch in batches:
            part = batch.column("_part").to_pylist()
            codes = []
            for p in part:
                seen[p] = seen.get(p, begin[p]) + 1
                codes.append(seen[p])
            yield pa.RecordBatch.from_arrays([batch.column("level"), pa.array(codes, pa.int64())], ["level", "code"])

    return parts.repartition("_part").sortWithinPartitions("_part", "level").select("level", "_part").mapInArrow(number, "level string, code long")


def with_codes(df: DataFrame, col: str, out_col: str, dictionary: DataFrame, first_code: int | None = None) -> DataFrame:
    """``df`` with the code of ``col`` (missing and unknown levels: missing). ``first_code`` renames the first level and numbers the
    rest from 1, as R's ``levels(f) = c(-999, 1:77)``."""
    code = F.col("code") if first_code is None else F.when(F.col("code") == 1, F.lit(first_code)).otherwise(F.col("code") - 1)
    known = broadcast_small(dictionary.select(F.col("level").alias("_level"), code.alias("_code")), BROADCAST_LEVELS)
    return df.withColumn("_level", F.col(col).cast("string")).join(known, "_level", "left").withColumn(out_col, F.col("_code")).drop("_level", "_code")


def design_matrix(df: DataFrame, numeric: Sequence[str], dictionaries: dict[str, DataFrame], out_col: str = "features") -> tuple[DataFrame, list]:
    """``df`` with a sparse vector of the numeric columns and an indicator for every level but the first of each column in
    ``dictionaries`` (R ``model.matrix``), for MLlib; and its blocks [(column, first position, size)]. Missing and
    unknown levels have no indicator, zeros take no room."""
    blocks, at, parts = [("numeric", 0, len(numeric))], len(numeric), list(numeric)
    for c, d in dictionaries.items():
        size = max(d.count() - 1, 0)
        blocks.append((c, at, size))
        if not size:
            continue
        # MLlib drops the last index: the first level and missing ones share it, and the column says how many there are
        code = F.when(F.col(f"_code_{c}") > 1, F.col(f"_code_{c}") - 2).otherwise(size).cast("double")
        nominal = {"ml_attr": {"type": "nominal", "name": f"_at_{c}", "num_vals": size + 1}}
        df = with_codes(df, c, f"_code_{c}", d).withColumn(f"_at_{c}", code.alias(f"_at_{c}", metadata=nominal)).drop(f"_code_{c}")
        df = OneHotEncoder(inputCol=f"_at_{c}", outputCol=f"_in_{c}", dropLast=True).fit(df.select(f"_at_{c}")).transform(df).drop(f"_at_{c}")
        parts, at = [*parts, f"_in_{c}"], at + size
    made = VectorAssembler(inputCols=parts, outputCol=out_col, handleInvalid="keep").transform(df)
    return made.drop(*[c for c in parts if c.startswith("_in_")]), blocks
