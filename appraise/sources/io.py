"""Scans and sinks: typed CSV, parquet checkpoints, CSV sink, model persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from appraise.session import scratch_path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null_value: str = "") -> DataFrame:
    """Header CSV with a declared schema; the empty string is missing (``fread(na.strings='')``).
    Rows whose text does not fit the schema become NULL cells (PERMISSIVE), never a failed job."""
    return (spark.read.schema(schema).option("header", True).option("nullValue", null_value)
            .option("mode", "PERMISSIVE").csv(path))


def write_csv(df: DataFrame, path: str, quote: bool = False) -> None:
    """CSV sink with a header and no row numbers; ``quote=False`` writes no quote characters
    (``write.csv(quote=FALSE)``). A directory of part files, one per partition."""
    w = df.write.mode("overwrite").option("header", True)
    if not quote:
        w = w.option("quote", "").option("escapeQuotes", False)
    w.csv(path)


def checkpoint_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a stage result to parquet in the shared checkpoint folder and read it back
    (the reference's saveRDS/readRDS): cuts lineage, so a lost executor recomputes from the
    written files, not from the first scan."""
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def save_model(model, path: str) -> None:
    """Persist a fitted ``PipelineModel`` / ``CrossValidatorModel`` (MLlib writer)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
