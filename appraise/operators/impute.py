"""Missing-value repair: constants, sentinels, presence flags, means, donor draws, lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.functions.hashing import keyed_hash
from appraise.functions.rsem import presence_flag
from appraise.operators.ranking import hash_rank

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names limited to the columns the table has (R ``intersect(names(df), L)``)."""
    have = set(df.columns)
    return [c for c in names if c in have]


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """R ``ifelse(is.na(x), k, x)`` per column; absent columns are ignored."""
    exprs = {c: F.coalesce(F.col(c), F.lit(k).cast(df.schema[c].dataType)) for c, k in values.items() if c in df.columns}
    return df.withColumns(exprs) if exprs else df


def fill_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fill 0 over a named list limited to the present columns."""
    return fill_constant(df, {c: 0 for c in present(df, names)})


def fill_sentinel(df: DataFrame, names: Iterable[str], sentinel: int = -1) -> DataFrame:
    """Categorical sentinel: NA → -1 (text columns get the text '-1')."""
    exprs = {}
    for c in present(df, names):
        t = df.schema[c].dataType
        lit = F.lit(str(sentinel)) if isinstance(t, T.StringType) else F.lit(sentinel).cast(t)
        exprs[c] = F.coalesce(F.col(c), lit)
    return df.withColumns(exprs) if exprs else df


def fill_all(df: DataFrame, sentinel: int = -999, skip: Iterable[str] = ()) -> DataFrame:
    """R ``df[is.na(df)] = -999``: every missing cell of every column, numeric and text
    (``na.fill(number)`` alone would skip text columns)."""
    skip = set(skip)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in skip:
            cols.append(c)
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.coalesce(c, F.lit(str(sentinel))).alias(f.name))
        elif isinstance(f.dataType, NUMERIC):
            cols.append(F.coalesce(c, F.lit(sentinel).cast(f.dataType)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def replace_value(df: DataFrame, old, new, names: Iterable[str] | None = None) -> DataFrame:
    """R ``df[df == old] = new`` over numeric columns (or the given ones)."""
    targets = names if names is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    exprs = {c: F.when(F.col(c) == F.lit(old), F.lit(new).cast(df.schema[c].dataType)).otherwise(F.col(c))
             for c in present(df, targets)}
    return df.withColumns(exprs) if exprs else df


def presence_flags(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Replace each listed column by its 0/1 presence flag."""
    exprs = {c: presence_flag(c) for c in present(df, names)}
    return df.withColumns(exprs) if exprs else df


def na_category(df: DataFrame, names: Iterable[str], label: str = "__NA__") -> DataFrame:
    """R ``addNA``: missing becomes a level of its own, apart from a real text 'NA'; the column becomes text."""
    exprs = {c: F.coalesce(F.col(c).cast("string"), F.lit(label)) for c in present(df, names)}
    return df.withColumns(exprs) if exprs else df


def column_means(df: DataFrame, names: Iterable[str]) -> dict[str, float | None]:
    """One-row aggregate (fetched: one number per column)."""
    names = list(names)
    row = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    return {c: row[c] for c in names}


def impute_mean(df: DataFrame, names: Iterable[str], means: Mapping[str, float] | None = None) -> DataFrame:
    """``Hmisc::impute(x, mean)``: NULL → column mean (mean of the non-missing values). An integer
    column becomes double, since a mean is not an integer; other types stay."""
    names = present(df, names)
    means = dict(means) if means is not None else column_means(df, names)
    exprs = {}
    for c in names:
        t = df.schema[c].dataType
        t = T.DoubleType() if isinstance(t, T.IntegralType) else t
        if means.get(c) is not None:
            exprs[c] = F.coalesce(F.col(c).cast(t), F.lit(means[c]).cast(t))
    return df.withColumns(exprs) if exprs else df


def fill_lookup(df: DataFrame, lookup: DataFrame, keys: list[str], target: str, value_col: str,
                max_lookup_rows: int = 5_000_000) -> DataFrame:
    """Fill missing ``target`` from a lookup table matched on ``keys`` (only where missing).

    The reference loops over the lookup rows with the last match winning; here one hash
    join does it, with a duplicate key resolved to the largest value so the result does not
    depend on row order. The lookup side is broadcast only when its row count is proven
    below ``max_lookup_rows``; otherwise Spark shuffles both sides on the keys.
    """
    lk = lookup.groupBy(*keys).agg(F.max(value_col).alias("_lookup_value"))
    if lookup.limit(max_lookup_rows + 1).count() <= max_lookup_rows:
        lk = F.broadcast(lk)
    missing = df.where(F.col(target).isNull())
    rest = df.where(F.col(target).isNotNull())
    filled = missing.join(lk, on=keys, how="left").withColumn(target, F.col("_lookup_value").cast(df.schema[target].dataType))
    return rest.unionByName(filled.drop("_lookup_value"))


def missing_keys(df: DataFrame, keys: list[str], target: str) -> DataFrame:
    """Distinct key combinations whose ``target`` is missing (what a lookup must cover)."""
    return df.where(F.col(target).isNull()).select(*keys).distinct()


def hot_deck(df: DataFrame, col: str, id_col: str, *, salt: str = "hotdeck", donor_filter: Column | None = None,
             replace: bool = True, out_col: str | None = None, report: dict | None = None,
             broadcast_donors_max: int = 1_000_000) -> DataFrame:
    """Random hot-deck: each missing ``col`` takes the value of a donor row drawn by hash.

    Donors are the rows with a present value (and ``donor_filter`` true). They get a
    dense 0-based slot in hash order (``hash_rank``, no global sort). A gap row with id k
    draws slot ``h(salt:pick, k) mod n_donors`` (with replacement, ``Hmisc::impute
    'random'``) or, without replacement (``sample(donors, n_gaps)``), slot = its own rank
    in hash order mod n_donors; when gaps outnumber donors the extra gaps reuse donors
    and are counted in ``report['reused']``. The draw is an equi-join on a unique slot, so
    the join has no hot key whatever the value distribution. With no donor at all the gap
    stays NULL (counted in ``report['unfilled']``).
    """
    out = out_col or col
    value, key = F.col(col), F.col(id_col)
    is_donor = value.isNotNull() if donor_filter is None else (value.isNotNull() & F.coalesce(donor_filter, F.lit(False)))
    donors = df.where(is_donor).select(key.alias("_id"), value.alias("_donor"))
    donors = donors.withColumn("_h", keyed_hash(f"{salt}:donor", "_id"))
    n_donors = donors.count()
    rest = df.where(value.isNotNull())
    gaps = df.where(value.isNull())
    if report is not None:
        n_gaps = gaps.count()
        report.update(donors=n_donors, gaps=n_gaps,
                      reused=0 if replace else max(0, n_gaps - n_donors),
                      unfilled=n_gaps if n_donors == 0 else 0)
    if out != col:
        rest = rest.withColumn(out, value)
    if n_donors == 0:
        return rest.unionByName(gaps.withColumn(out, value))
    slots = hash_rank(donors, "_h", "_id", rank_col="_slot", n_rows=n_donors).select("_slot", "_donor")
    if n_donors <= broadcast_donors_max:
        slots = F.broadcast(slots)
    gaps = gaps.withColumn("_gh", keyed_hash(f"{salt}:pick", key))
    if replace:
        gaps = gaps.withColumn("_slot", F.col("_gh") % F.lit(n_donors))
    else:
        gaps = hash_rank(gaps, "_gh", id_col, rank_col="_grank").withColumn("_slot", F.col("_grank") % F.lit(n_donors))
    filled = gaps.join(slots, "_slot", "left").withColumn(out, F.col("_donor").cast(df.schema[col].dataType))
    return rest.unionByName(filled.select(*rest.columns))


def hot_deck_many(df: DataFrame, specs: Mapping[str, tuple], id_col: str, *, salt: str = "hotdeck",
                  broadcast_donors_max: int = 1_000_000) -> DataFrame:
    """``hot_deck`` for several columns at once, with a fixed number of passes.

    ``specs``: {column: (allowed values or None, replace)}. Column c gives the same values as
    ``hot_deck(df, c, id_col, salt=f"{salt}:{c}", ...)``. The columns are unpivoted to
    (id, column, value); donors get slots per column (``hash_rank`` by column), every gap
    draws its slot, ONE equi-join on (column, slot) fetches all draws, a pivot folds them back
    to one row per id, and only the rows that have a gap are joined to it. Values travel as
    text, which is exact for integers, decimals, doubles, dates and texts alike, and are cast back to
    each column's type. A column with no donor keeps its gaps.
    """
    cols = [c for c in specs if c in df.columns]
    if not cols:
        return df
    key = F.col(id_col)
    cells = [F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_v"),
                      (F.lit(True) if specs[c][0] is None else F.coalesce(F.col(c).isin(list(specs[c][0])), F.lit(False))).alias("_ok"))
             for c in cols]
    long = df.select(key.alias("_id"), F.explode(F.array(*cells)).alias("_cell")).select("_id", "_cell.*")
    is_donor = F.col("_v").isNotNull() & F.col("_ok")
    donors = long.where(is_donor)
    # donors and gaps per column in ONE grouped pass (k rows)
    tallies = long.groupBy("_c").agg(F.count_if(is_donor).alias("n"), F.count_if(F.col("_v").isNull()).alias("g")).collect()
    counts = {r["_c"]: r["n"] for r in tallies if r["n"] > 0}
    gap_counts = {r["_c"]: r["g"] for r in tallies}
    live = [c for c in cols if counts.get(c, 0) > 0]
    if not live:
        return df
    n_of = F.lit(None).cast("bigint")
    for c in live:
        n_of = F.when(F.col("_c") == F.lit(c), F.lit(counts[c])).otherwise(n_of)
    donors = donors.where(F.col("_c").isin(live)) \
        .withColumn("_h", keyed_hash(F.concat(F.lit(f"{salt}:"), F.col("_c"), F.lit(":donor")), "_id"))
    slots = hash_rank(donors, "_h", "_id", partition_cols=["_c"], rank_col="_slot",
                      n_rows=sum(counts.values())).select("_c", "_slot", F.col("_v").alias("_donor"))
    if sum(counts[c] for c in live) <= broadcast_donors_max:
        slots = F.broadcast(slots)
    gaps = long.where(F.col("_v").isNull() & F.col("_c").isin(live)) \
        .withColumn("_gh", keyed_hash(F.concat(F.lit(f"{salt}:"), F.col("_c"), F.lit(":pick")), "_id"))
    without = [c for c in live if not specs[c][1]]
    if without:
        ranked = hash_rank(gaps.where(F.col("_c").isin(without)), "_gh", "_id", partition_cols=["_c"], rank_col="_grank",
                           n_rows=sum(gap_counts.get(c, 0) for c in without))
        gaps = gaps.where(~F.col("_c").isin(without)).withColumn("_grank", F.col("_gh")).unionByName(ranked)
    else:
        gaps = gaps.withColumn("_grank", F.col("_gh"))
    gaps = gaps.withColumn("_slot", F.col("_grank") % n_of)
    draws = gaps.join(slots, ["_c", "_slot"], "inner").select("_id", "_c", "_donor")
    fills = draws.groupBy("_id").pivot("_c", live).agg(F.first("_donor"))
    fills = fills.select(F.col("_id").alias(id_col), *[F.col(c).alias(f"_fill_{c}") for c in live])
    any_gap = F.lit(False)
    for c in live:
        any_gap = any_gap | F.col(c).isNull()
    complete = df.where(~any_gap)
    patched = df.where(any_gap).join(fills, id_col, "left")
    patched = patched.select(*[
        F.coalesce(F.col(c), F.col(f"_fill_{c}").cast(df.schema[c].dataType)).alias(c) if c in live else F.col(c)
        for c in df.columns])
    return complete.unionByName(patched)
