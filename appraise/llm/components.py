"""Connected components of an edge table with DataFrame joins and aggregates only.

Alternating star contraction: every vertex hangs its larger neighbours on the least vertex it knows
(large star), then its smaller ones (small star), until all edges of a component point at its least vertex.
Each round is a partially aggregated minimum and an equi-join whose other side is unique by key, so that a
hub's rows can be split at run time; rounds grow with the logarithm of a component's diameter. Each round is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm import tables


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """id, root for every id that an edge (a, b) of two different, non-null ids touches, but the roots themselves:
    root is the least id that the id is connected to. Null ends and loops are no edges; repeated edges count once."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now, seen = tables.written(now, name), None
    for _ in range(rounds):
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
        if state == seen or not state.n:
            return now.select(F.col("hi").alias("id"), F.col("lo").alias("root"))
        seen = state
        both = now.select(F.col("lo").alias("v"), F.col("lo").alias("w")).union(now.select(F.col("hi").alias("v"), F.col("lo").alias("w")))
        least = both.groupBy("v").agg(F.min("w").alias("m"))
        large = now.join(least, now.lo == least.v).select("hi", F.col("m").alias("lo")).where("hi <> lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = tables.written(low.select("hi", F.col("m").alias("lo")).union(small).distinct(), name)
    raise RuntimeError(f"components: no end after {rounds} rounds")
