"""Sampling and resampling queries (inventory 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from appraise.operators import sampling as R
from appraise.plans.registry import register
from appraise.plans.sqltext import PROPS, SALES, h, h_dyn, strata_cte, with_
from appraise.sources import standins as S


@register("split_stratified", with_(SALES, strata_cte("sales", "logerror", "sale_key", "split")) + """
SELECT sale_key, rnk < ceil(0.6 * n_s) AS is_train FROM ranked""")
def split_stratified(spark, sf):
    """Outcome-stratified 60 % training split (ceil(p n) per quartile stratum)."""
    s = S.sales(spark, sf).select("sale_key", "logerror")
    return R.split_stratified(s, "logerror", "sale_key", 0.6).select("sale_key", "is_train")


SPLIT_RANDOM_SQL = with_(PROPS) + f""",
r AS (SELECT id_parcel, row_number() OVER (ORDER BY {h('random-split', 'id_parcel')}, id_parcel) - 1 AS rnk FROM props),
sp AS (SELECT id_parcel, rnk < floor(0.75 * (SELECT count(*) FROM props)) AS is_train FROM r)"""


def _split_random(spark, sf):
    return R.split_random(S.properties(spark, sf).select("id_parcel"), "id_parcel", 0.75)


@register("split_random", SPLIT_RANDOM_SQL + "\nSELECT id_parcel, is_train FROM sp")
def split_random(spark, sf):
    """R2: plain 75/25 split, exactly floor(0.75 n) training rows."""
    return _split_random(spark, sf)


@register("split_share", SPLIT_RANDOM_SQL + """
SELECT count(*) AS n, CAST(sum(CAST(is_train AS INTEGER)) AS BIGINT) AS n_train,
       round(avg(CAST(is_train AS DOUBLE)), 8) AS share FROM sp""")
def split_share(spark, sf):
    """Row count and training share of a split."""
    sp = _split_random(spark, sf)
    return sp.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_train").cast("int")).cast("bigint").alias("n_train"),
                  F.round(F.avg(F.col("is_train").cast("double")), 8).alias("share"))


@register("folds_stratified", with_(SALES, strata_cte("sales", "logerror", "sale_key", "folds")) + """
SELECT sale_key, CAST(rnk % 3 AS INTEGER) AS fold FROM ranked""")
def folds_stratified(spark, sf):
    """Three balanced folds inside each outcome stratum."""
    s = S.sales(spark, sf).select("sale_key", "logerror")
    return R.stratified_folds(s, "logerror", "sale_key", 3).select("sale_key", "fold")


@register("bootstrap_weights", with_(PROPS) + f""",
nn AS (SELECT count(*) AS n FROM props),
r AS (SELECT id_parcel, row_number() OVER (ORDER BY {h('boot-order', 'id_parcel')}, id_parcel) - 1 AS rnk FROM props),
d AS (SELECT CAST(i // n AS INTEGER) AS resample, i % n AS draw, n FROM (SELECT unnest(range(5 * n)) AS i, n FROM nn)),
pk AS (SELECT resample, {h_dyn("'boot' || CAST(resample AS VARCHAR)", 'draw')} % n AS rnk, count(*) AS w
       FROM d GROUP BY ALL),
g AS (SELECT r.id_parcel, r.rnk, CAST(b.resample AS INTEGER) AS resample FROM r, range(5) b(resample))
SELECT g.resample, g.id_parcel, CAST(coalesce(pk.w, 0) AS BIGINT) AS weight
FROM g LEFT JOIN pk ON g.resample = pk.resample AND g.rnk = pk.rnk""")
def bootstrap_weights(spark, sf):
    """Five bootstrap resamples of n draws with replacement; weight 0 = out of bag."""
    return R.bootstrap_weights(S.properties(spark, sf).select("id_parcel"), "id_parcel", 5)


@register("shuffle_column", with_(PROPS) + f""",
a AS (SELECT id_parcel, row_number() OVER (ORDER BY {h('permute:a', 'id_parcel')}, id_parcel) AS rk FROM props),
b AS (SELECT tax_total, row_number() OVER (ORDER BY {h('permute:b', 'id_parcel')}, id_parcel) AS rk FROM props)
SELECT a.id_parcel, b.tax_total FROM a JOIN b USING (rk)""")
def shuffle_column(spark, sf):
    """V7 (the shuffle): a repeatable permutation of one column across rows."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total")
    return R.shuffle_column(p, "tax_total", "id_parcel").select("id_parcel", "tax_total")
