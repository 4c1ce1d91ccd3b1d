"""Reading the corpus tables and writing intermediate ones.

Every intermediate is Parquet under the shared folder that ``spark.checkpoint.dir`` names, so a lost
executor costs the re-reading of a file and never the re-running of what came before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text as (long, string), with the further columns asked for; other columns never matter."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def training(doc_id: str, modulus: int):
    """crc32 of the decimal doc_id is not 0 modulo ``modulus`` (a null id: crc32 of the empty text, so held out)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus != 0


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(docs: DataFrame):
    """A binary column that is equal for rows of equal doc_id and text only."""
    own = F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    return F.unhex(F.md5(own.cast("binary")))


#: A set of row keys of at most this many rows (16 bytes each) is broadcast to an anti-join; a larger one is joined by shuffle.
BROADCAST_KEYS = 200_000


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose row key is not in ``keys`` (one column, key)."""
    own = fresh(docs, "__key")
    keys = written(keys.select(F.col("key").alias(own)).distinct(), "keys-out")
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return docs.withColumn(own, row_key(docs)).join(keys, own, "left_anti").select(*docs.columns)


class Rows:
    """Numbers the rows of a task: unique over the DataFrame, and the same when the task runs again on the same split."""

    def __init__(self):
        from pyspark import TaskContext
        self.next = TaskContext.get().partitionId() << 36

    def take(self, n: int) -> pa.Array:
        self.next += n
        return pa.array(np.arange(self.next - n, self.next, dtype=np.int64))


def bitmap(keys: DataFrame, bit, bits: int) -> np.ndarray:
    """The set bits of ``bit`` (a long column, 0 .. bits-1) as bytes, least bit first. The aggregate returns at most
    bits / 32768 rows of 4 KB, whatever the number of keys."""
    at = bit + 1  # bitmap_bucket_number counts positions from 1
    got = (keys.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p"))
           .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect())
    out = np.zeros(max(bits // 8, 4096), np.uint8)
    for r in got:
        out[(r.b - 1) * 4096:r.b * 4096] = np.frombuffer(r.m, np.uint8)
    return out
