"""Joins of sale facts to property attributes, lookups and month expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A small *derived* table (an aggregate over few groups) made a broadcast side with a
    proven bound: it is computed once, at most ``max_rows + 1`` rows are fetched, and when the
    bound holds the rows become a local relation that Spark broadcasts (the big side is then
    joined in place, no shuffle of it). Past the bound the table is returned as is and the
    planner / AQE shuffle both sides."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def join_facts(facts: DataFrame, props: DataFrame, key: str = "id_parcel", how: str = "inner") -> DataFrame:
    """Facts to properties: ``inner`` (dplyr ``inner_join``) or ``right`` with properties on the
    left (``merge(p, t, all.y=TRUE)``: every fact row kept)."""
    return skew_join(facts, props, key, "left" if how == "right" else how)


def hot_keys(df: DataFrame, key: str, hot_share: float = 0.01) -> list:
    """Keys holding more than ``hot_share`` of the rows. There are at most ``1 / hot_share`` of
    them, so fetching them is bounded; the count per key is a partially aggregated shuffle."""
    total = df.count()
    if total == 0:
        return []
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(hot_share * total))
    return [r[0] for r in hot.select(key).limit(int(1 / hot_share) + 1).collect()]


def skew_join(facts: DataFrame, props: DataFrame, key: str, how: str = "inner", hot_share: float = 0.01,
              buckets: int = 64) -> DataFrame:
    """Fact-to-attribute join that splits hot keys: fact rows of a hot key are spread over
    ``buckets`` salts by a hash of the row, and the attribute row of that key is replicated
    once per salt; every other key keeps salt 0 and one copy. Same result as the plain join
    (``inner`` or ``left`` from the facts side), without a task that holds a third of the rows."""
    hot = hot_keys(facts, key, hot_share)
    if not hot:
        return facts.join(props, key, how)
    is_hot = F.coalesce(F.col(key).isin([k for k in hot if k is not None]), F.lit(False))
    if None in hot:  # missing keys match nothing, but a left join keeps their rows: spread them too
        is_hot = is_hot | F.col(key).isNull()
    row_hash = F.xxhash64(*[F.col(c) for c in facts.columns])
    f = facts.withColumn("_salt", F.when(is_hot, F.pmod(row_hash, F.lit(buckets))).otherwise(F.lit(0)).cast("int"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    p = props.withColumn("_salt", F.explode(salts))
    return f.join(p, [key, "_salt"], how).drop("_salt")


def right_join_prefixed(left: DataFrame, right: DataFrame, key: str, prefix: str = "i_") -> DataFrame:
    """data.table ``left[right]``: every row of ``right``; ``right`` columns whose names clash
    with ``left`` get ``prefix`` (Spark would keep two equal names)."""
    clash = [c for c in right.columns if c in left.columns and c != key]
    r = right.withColumnsRenamed({c: prefix + c for c in clash})
    return skew_join(r, left, key, "left").select(key, *[c for c in left.columns if c != key],
                                             *[c for c in r.columns if c != key])


def cross_months(df: DataFrame, months: Sequence[tuple[int, str]], code_col: str = "month",
                 label_col: str = "label") -> DataFrame:
    """Every row once per (month code, label): an ``explode`` of a literal array, so no join
    and no shuffle; each input partition fans out locally."""
    arr = F.array(*[F.struct(F.lit(code).alias(code_col), F.lit(label).alias(label_col)) for code, label in months])
    return df.withColumn("_m", F.explode(arr)).select(*[c for c in df.columns if c != code_col], "_m.*")
