"""Exact rank of rows in hash order, without a global sort.

``row_number() over (partition by g order by h, id)`` on a few large groups puts each
group into one task. ``hash_rank`` gives the same numbers with bounded windows: rows
are binned by the top ``bits`` bits of their 60-bit hash (bins are contiguous ranges of
the hash order), a small table holds the per-(group, bin) counts and their running
offsets, and ``row_number`` runs only inside a (group, bin). A group that holds a
third of all rows is still spread over 2^bits bins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appraise.functions.hashing import HASH_BITS

ROWS_PER_BIN = 1 << 14
MAX_BITS = 20


def bits_for(n_rows: int) -> int:
    """Hash bits so that a bin holds about ``ROWS_PER_BIN`` rows (at most 2^20 bins)."""
    return min(MAX_BITS, max(0, math.ceil(math.log2(max(n_rows, 1) / ROWS_PER_BIN))))


def hash_rank(df: DataFrame, hash_col: str, id_col: str, *, partition_cols: Sequence[str] = (),
              rank_col: str = "_rank", count_col: str | None = None, bits: int | None = None,
              n_rows: int | None = None, broadcast_offsets: bool | None = None) -> DataFrame:
    """Add ``rank_col`` = 0-based rank within ``partition_cols`` ordered by (hash, id); optionally
    ``count_col`` = size of the group. ``hash_col`` must lie in [0, 2^60) and ``id_col`` be unique.

    The bin count follows the row count (``n_rows`` when the caller knows it, else one count):
    about 16k rows per window partition up to 1.7e10 rows, beyond that a 2^20th of the rows, and an offset
    table of at most 2^20 rows per group."""
    parts = list(partition_cols)
    if bits is None:
        bits = bits_for(n_rows if n_rows is not None else df.count())
    # group keys as plain non-null columns (text value + null flag): the rank window and the
    # offset join then use the SAME keys, so the join reuses the window's partitioning instead of
    # shuffling the data again (a null-safe join would re-key on coalesce/isnull expressions)
    keys = []
    for i, c in enumerate(parts):
        df = df.withColumns({f"_gk{i}": F.coalesce(F.col(c).cast("string"), F.lit("")), f"_gn{i}": F.col(c).isNull()})
        keys += [f"_gk{i}", f"_gn{i}"]
    binned = df.withColumn("_bin", F.shiftright(F.col(hash_col), HASH_BITS - bits))
    counts = binned.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_bin_n"))
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_bin_start", F.coalesce(F.sum("_bin_n").over(before), F.lit(0)))
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_bin_n").over(Window.partitionBy(*keys)))
    offsets = offsets.drop("_bin_n")
    # without group columns the offset table has at most 2^bits <= 2^16 rows: a proven broadcast
    # bound; otherwise the planner / AQE pick the join from the real sizes
    if broadcast_offsets is None:
        broadcast_offsets = not parts and bits <= 16
    if broadcast_offsets:
        offsets = F.broadcast(offsets)
    local = Window.partitionBy(*keys, "_bin").orderBy(F.col(hash_col), F.col(id_col))
    ranked = binned.withColumn("_local", F.row_number().over(local) - 1)
    out = ranked.join(offsets, on=[*keys, "_bin"], how="inner").drop(*keys)
    return out.withColumn(rank_col, F.col("_bin_start") + F.col("_local")).drop("_bin", "_bin_start", "_local")
