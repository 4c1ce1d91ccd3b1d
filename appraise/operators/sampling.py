"""Repeatable sampling: stratified split, random split, stratified folds, bootstrap, column shuffle.

Every draw is a keyed hash of a unique id (``appraise.functions.hashing``), so the same
rows come out on every run and partitioning, and a SQL engine with md5 can check them.
Ranks are exact and come from ``hash_rank`` (bounded windows, no global sort).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.functions.hashing import HASH_BITS, keyed_hash
from appraise.operators.quantiles import exact_quantiles, quantiles_and_counts
from appraise.operators.ranking import bits_for, hash_rank


def row_counts(df: DataFrame, col: str) -> tuple[int, int]:
    """(all rows, rows with ``col`` present) in one pass."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count(col).alias("m")).first()
    return int(r["n"]), int(r["m"])


def strata_cuts(df: DataFrame, y_col: str, groups: int = 4) -> tuple[list, int]:
    """Quantile cut points of the outcome and the total row count, from the same passes."""
    cuts, _present, total = quantiles_and_counts(df, y_col, [k / groups for k in range(1, groups)])
    return cuts, total


def with_strata(df: DataFrame, y_col: str, groups: int = 4, out_col: str = "stratum",
                cuts: list | None = None) -> DataFrame:
    """Outcome strata (caret's numeric-outcome bins): cut at the (1/g .. (g-1)/g) exact quantiles,
    intervals closed on the right; 0-based stratum; a missing outcome is its own (NULL) stratum."""
    if cuts is None:
        cuts = exact_quantiles(df, y_col, [k / groups for k in range(1, groups)])
    y = F.col(y_col)
    s = F.lit(0)
    for c in cuts:
        s = s + F.when(y > F.lit(c), 1).otherwise(0)
    return df.withColumn(out_col, F.when(y.isNull(), F.lit(None)).otherwise(s).cast("int"))


def _categorical(df: DataFrame, y_col: str) -> bool:
    from pyspark.sql import types as T
    return isinstance(df.schema[y_col].dataType, (T.StringType, T.BooleanType))


#: Strata whose thresholds go into the filter as literals; with more, rows are ranked instead.
MAX_STRATA = 1000


def hash_thresholds(df: DataFrame, hash_col: str, id_col: str, strata: Sequence[str], wanted, n_rows: int) -> list | None:
    """For each stratum the (hash, id) of its k-th row in (hash, id) order, by radix selection: counts of the hash's top bits
    by stratum, the bin that holds the k-th row, and that bin's rows up to it. ``wanted`` gives k from the stratum's size. No row is
    shuffled but those of one bin a stratum (about 16k rows). Rows (stratum values, k, hash, id), hash None where k is 0;
    None where there are more than ``MAX_STRATA`` strata."""
    bits = bits_for(n_rows)
    binned = df.withColumn("_bin", F.shiftright(F.col(hash_col), HASH_BITS - bits))
    counts = binned.groupBy(*strata, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*strata).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumns({"_end": F.sum("_c").over(upto), "_n": F.sum("_c").over(Window.partitionBy(*strata))})
    # the bin of the k-th row, or the first bin where k is 0
    counts = counts.withColumn("_k", wanted(F.col("_n")).cast("long"))
    holds = counts.where((F.greatest("_k", F.lit(1)) <= F.col("_end")) & (F.greatest("_k", F.lit(1)) > F.col("_end") - F.col("_c")))
    bins = holds.select(*strata, "_bin", "_k", (F.col("_k") - F.col("_end") + F.col("_c")).alias("_left")).limit(MAX_STRATA + 1).collect()
    if len(bins) > MAX_STRATA:
        return None
    if not bins:
        return []
    kinds = T.StructType([*(df.schema[c] for c in strata), *(T.StructField(c, T.LongType()) for c in ("_bin", "_k", "_left"))])
    near = df.sparkSession.createDataFrame(bins, kinds)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in strata] + [F.col("a._bin") == F.col("b._bin")]
    rows = binned.alias("a").join(F.broadcast(near.alias("b")), same).select(*[F.col(f"a.{c}") for c in strata], F.col(f"a.{hash_col}"), F.col(f"a.{id_col}"), "b._left")
    order = Window.partitionBy(*strata).orderBy(hash_col, id_col)
    kth = rows.withColumn("_r", F.row_number().over(order)).where("_r = _left")
    at = {tuple(r[c] for c in strata): (r[hash_col], r[id_col]) for r in kth.collect()}  # a row for each stratum
    return [(*key, r["_k"], *at.get(key, (None, None))) for r in bins for key in [tuple(r[c] for c in strata)]]


def _up_to(thresholds: list, strata: Sequence[str], hash_col: str, id_col: str):
    """Whether a row is among the first k of its stratum, as a plain expression."""
    out = F.lit(False)
    for *key, k, h, last in thresholds:
        if k:
            inside = F.lit(True)
            for c, v in zip(strata, key):
                inside = inside & F.col(c).eqNullSafe(F.lit(v))
            first = (F.col(hash_col) < h) | ((F.col(hash_col) == h) & (F.col(id_col) <= F.lit(last)))
            out = F.when(inside, first).otherwise(out)
    return out


def split_stratified(df: DataFrame, y_col: str, id_col: str, p: float, *, salt: str = "split",
                     groups: int = 4, out_col: str = "is_train", keep_helpers: bool = False,
                     categorical: bool | None = None) -> DataFrame:
    """caret ``createDataPartition(y, p)``: in each outcome stratum the ``ceil(p * n_s)`` rows with
    the smallest ``h(salt, id)`` are the training rows. Strata are quantile bins of a numeric y,
    or the classes themselves when y is categorical (text / boolean, or ``categorical=True``). The split is a filter
    on thresholds found by radix selection; rows are ranked (and shuffled) only where the helper
    columns are kept or the outcome has more than ``MAX_STRATA`` classes."""
    categorical = _categorical(df, y_col) if categorical is None else categorical
    if categorical:
        n, _m = row_counts(df, y_col)
        s = df.withColumn("_stratum", F.col(y_col).cast("string"))
    else:
        cuts, n = strata_cuts(df, y_col, groups)
        s = with_strata(df, y_col, groups, "_stratum", cuts=cuts)
    s = s.withColumn("_h", keyed_hash(salt, id_col))

    def wanted(size):
        return F.ceil(F.lit(float(p)) * size)

    thresholds = None if keep_helpers else hash_thresholds(s.select("_stratum", "_h", id_col), "_h", id_col, ["_stratum"], wanted, n)
    if thresholds is not None:
        return s.withColumn(out_col, _up_to(thresholds, ["_stratum"], "_h", id_col)).drop("_stratum", "_h")
    r = hash_rank(s, "_h", id_col, partition_cols=["_stratum"], count_col="_n", n_rows=n)
    out = r.withColumn(out_col, F.col("_rank") < wanted(F.col("_n")))
    return out if keep_helpers else out.drop("_stratum", "_h", "_rank", "_n")


def split_random(df: DataFrame, id_col: str, share: float, *, salt: str = "random-split",
                 out_col: str = "is_train") -> DataFrame:
    """R ``sample(1:n, share*n)``: exactly ``floor(share * n)`` training rows, smallest hashes: a filter on the threshold that
    radix selection finds, so no row is shuffled."""
    n = df.count()
    k = int(math.floor(share * n))
    s = df.withColumn("_h", keyed_hash(salt, id_col))
    thresholds = hash_thresholds(s.select("_h", id_col), "_h", id_col, [], lambda _size: F.lit(k), n)
    return s.withColumn(out_col, _up_to(thresholds, [], "_h", id_col)).drop("_h")


def stratified_folds(df: DataFrame, y_col: str, id_col: str, k: int = 3, *, salt: str = "folds",
                     groups: int = 4, out_col: str = "fold", rank_col: str | None = None) -> DataFrame:
    """caret ``createFolds(y, k)``: balanced 0-based folds inside each outcome stratum
    (rank in hash order mod k). Usable as ``CrossValidator(foldCol=...)``. ``rank_col`` keeps
    the stratum rank, from which any other fold count is ``rank mod k`` without a new pass."""
    cuts, n = strata_cuts(df, y_col, groups)
    s = with_strata(df, y_col, groups, "_stratum", cuts=cuts).withColumn("_h", keyed_hash(salt, id_col))
    r = hash_rank(s, "_h", id_col, partition_cols=["_stratum"], n_rows=n)
    out = r.withColumn(out_col, (F.col("_rank") % F.lit(k)).cast("int"))
    if rank_col:
        out = out.withColumnRenamed("_rank", rank_col)
    return out.drop("_stratum", "_h", "_rank")


def bootstrap_weights(df: DataFrame, id_col: str, resamples: int = 5, *, salt: str = "boot",
                      rank_salt: str = "boot-order") -> DataFrame:
    """caret ``trainControl(method='boot', number=B)``: B resamples of n draws with replacement.

    Draw j of resample b picks the row whose hash rank is ``h(salt||b, j) mod n``; a row's
    weight is the number of draws that picked it (0 = out of bag). The draws are a
    distributed ``range(B*n)`` aggregated by picked rank (uniform keys, no hot group),
    then joined to the rows by rank. Returns (resample, id, weight) for every row and resample.
    """
    n = df.count()
    spark = df.sparkSession
    ranked = hash_rank(df.select(id_col).withColumn("_h", keyed_hash(rank_salt, id_col)), "_h", id_col,
                       rank_col="_rank", n_rows=n).select(id_col, "_rank")
    draws = (spark.range(0, resamples * n)
             .select((F.col("id") / F.lit(n)).cast("bigint").cast("int").alias("resample"),
                     (F.col("id") % F.lit(n)).alias("_draw")))
    picks = (draws.withColumn("_rank", keyed_hash(F.concat(F.lit(salt), F.col("resample").cast("string")), "_draw") % F.lit(n))
             .groupBy("resample", "_rank").agg(F.count(F.lit(1)).alias("weight")))
    # every row once per resample: a local explode, no join
    grid = ranked.withColumn("resample", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))))
    out = grid.join(picks, ["resample", "_rank"], "left")
    return out.select("resample", id_col, F.coalesce(F.col("weight"), F.lit(0)).cast("bigint").alias("weight"))


#: Bits of a weight in a long, and weights in a long.
_BITS, _PACKED = 12, 5


def bootstrap_columns(df: DataFrame, id_col: str, resamples: int = 5, *, salt: str = "boot", rank_salt: str = "boot-order") -> DataFrame:
    """The weights of ``bootstrap_weights`` side by side: (id, w0, w1, ...), a row for each different id. The draws on a rank come to a
    single row, whose weights are packed into a long, so that rows are shuffled once for all resamples."""
    n = df.count()
    ranked = hash_rank(df.select(id_col).withColumn("_h", keyed_hash(rank_salt, id_col)), "_h", id_col, rank_col="_rank", n_rows=n).select(id_col, "_rank")
    draws = df.sparkSession.range(0, resamples * n).select((F.col("id") / F.lit(n)).cast("bigint").cast("int").alias("resample"), (F.col("id") % F.lit(n)).alias("_draw"))
    one = F.expr(f"shiftleft(1L, {_BITS} * (resample % {_PACKED}))")
    packs = [F.sum(F.when(F.floor(F.col("resample") / _PACKED) == j, one).otherwise(0)).alias(f"_p{j}") for j in range(math.ceil(resamples / _PACKED))]
    picks = draws.select("resample", (keyed_hash(F.concat(F.lit(salt), F.col("resample").cast("string")), "_draw") % F.lit(n)).alias("_rank")).groupBy("_rank").agg(*packs)
    weight = [F.shiftright(f"_p{b // _PACKED}", _BITS * (b % _PACKED)).bitwiseAND(F.lit((1 << _BITS) - 1)) for b in range(resamples)]
    return ranked.join(picks, "_rank", "left").groupBy(id_col).agg(*[F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias(f"w{b}") for b, w in enumerate(weight)])


def shuffle_column(df: DataFrame, col: str, id_col: str, *, salt: str = "permute", out_col: str | None = None) -> DataFrame:
    """A repeatable random permutation of one column's values across rows (permutation importance).
    The row at rank i in ``h(salt:a)`` order receives the value of the row at rank i in
    ``h(salt:b)`` order: two exact hash ranks and one equi-join on a unique rank."""
    out = out_col or col
    n = df.count()
    a = hash_rank(df.withColumn("_ha", keyed_hash(f"{salt}:a", id_col)), "_ha", id_col, rank_col="_ra",
                  n_rows=n).drop("_ha")
    b = hash_rank(df.select(id_col, F.col(col).alias("_donor")).withColumn("_hb", keyed_hash(f"{salt}:b", id_col)),
                  "_hb", id_col, rank_col="_ra", n_rows=n).select("_ra", "_donor")
    res = a.join(b, "_ra", "inner")
    return res.withColumn(out, F.col("_donor").cast(df.schema[col].dataType)).drop("_ra", "_donor")
