"""Recoding, encoding and scaling queries (inventory 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from appraise.functions import rsem
from appraise.functions.hashing import keyed_hash
from appraise.operators import encode as E
from appraise.operators import foldstats as L
from appraise.operators import impute as I
from appraise.operators import scale as Z
from appraise.operators.dictionary import level_dictionary
from appraise.operators.sampling import stratified_folds
from appraise.plans.registry import register
from appraise.plans.sqltext import PARTS, PROPS, SALES, h, strata_cte, with_
from appraise.sources import standins as S

PRIORITY_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("ordinal_encode", with_(PROPS) + """,
filled AS (SELECT id_parcel, coalesce(zoning, '-1') AS zoning FROM props),
lv AS (SELECT zoning, dense_rank() OVER (ORDER BY zoning) AS dr FROM (SELECT DISTINCT zoning FROM filled))
SELECT f.id_parcel, CAST(CASE WHEN lv.dr = 1 THEN -999 ELSE lv.dr - 1 END AS INTEGER) AS zoning_code
FROM filled f JOIN lv USING (zoning)""")
def ordinal_encode(spark, sf):
    """Sorted levels → codes, first level renamed -999, the rest 1..n-1."""
    p = I.fill_sentinel(S.properties(spark, sf).select("id_parcel", "zoning"), ["zoning"])
    return E.level_codes(p, "zoning", "zoning_code", first_code=-999).select("id_parcel", "zoning_code")


@register("flag_to_number", with_(SALES) + """
SELECT sale_key, CASE WHEN f IS NULL THEN NULL WHEN f = 'true' THEN 1 ELSE -1 END AS flag_num
FROM (SELECT sale_key, CASE flag WHEN 'R' THEN 'true' WHEN 'A' THEN 'false' END AS f FROM sales)""")
def flag_to_number(spark, sf):
    """E2: 'true' → 1, other text → -1, missing stays missing."""
    s = S.sales(spark, sf).withColumn("f", F.when(F.col("flag") == "R", "true").when(F.col("flag") == "A", "false"))
    return s.select("sale_key", rsem.flag_to_number("f", "true", 1, -1).alias("flag_num"))


@register("merge_flags", with_(SALES) + """
SELECT sale_key, CASE WHEN n IS NOT NULL THEN '1' WHEN f = 'true' THEN '2' ELSE coalesce(f, '0') END AS flag_fireplace
FROM (SELECT sale_key, CASE WHEN linenumber > 5 THEN 1 END AS n, CASE WHEN flag = 'R' THEN 'true' END AS f FROM sales)""")
def merge_flags(spark, sf):
    """Count present → '1', else flag 'true' → '2', else missing → '0'."""
    s = S.sales(spark, sf).select("sale_key", F.when(F.col("linenumber") > 5, 1).alias("n"),
                                  F.when(F.col("flag") == "R", "true").alias("f"))
    return s.select("sale_key", rsem.merged_flag("n", "f").alias("flag_fireplace"))


@register("collapse_levels", with_(PARTS) + """
SELECT p_partkey, CASE WHEN coalesce(size_gap BETWEEN 4 AND 41, false) THEN 'other' ELSE CAST(size_gap AS VARCHAR) END AS size_level
FROM parts""")
def collapse_levels(spark, sf):
    """Tail levels 4..41 → 'other' (text column)."""
    return S.parts(spark, sf).select("p_partkey", rsem.collapse_levels("size_gap", 4, 41).alias("size_level"))


@register("one_hot", """
SELECT o_orderkey AS id_parcel,
       CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prio_2_HIGH,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prio_3_MEDIUM,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prio_4_NOT_SPECIFIED,
       CASE WHEN o_orderpriority = '5-LOW' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prio_5_LOW
FROM orders""")
def one_hot(spark, sf):
    """E5: one 0/1 column per level, first level dropped, no intercept column."""
    o = S.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id_parcel"), F.col("o_orderpriority").alias("prio"))
    return E.one_hot(o, "prio").drop("prio")


@register("zscore", with_(PROPS) + """
SELECT id_parcel,
       round((tax_total - avg(tax_total) OVER ()) / stddev_samp(tax_total) OVER (), 8) AS tax_total,
       round((region_zip - avg(region_zip) OVER ()) / stddev_samp(region_zip) OVER (), 8) AS region_zip
FROM props""")
def zscore(spark, sf):
    """Z-score of every column (sample sd), id put back."""
    p = Z.zscore(S.properties(spark, sf).select("id_parcel", "tax_total", "region_zip"), ["tax_total", "region_zip"])
    return p.select("id_parcel", F.round("tax_total", 8).alias("tax_total"), F.round("region_zip", 8).alias("region_zip"))


@register("zscore_train_only", with_(PROPS) + f""",
t AS (SELECT *, {h('train', 'id_parcel')} < {3 << 58} AS is_train FROM props),
m AS (SELECT avg(tax_total) AS mu, stddev_samp(tax_total) AS sd FROM t WHERE is_train)
SELECT id_parcel, is_train, round((tax_total - mu) / sd, 8) AS tax_total FROM t, m""")
def zscore_train_only(spark, sf):
    """Centre and scale with statistics of the training rows only, applied to every row."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total")
    p = p.withColumn("is_train", keyed_hash("train", "id_parcel") < F.lit(3 << 58))
    z = Z.zscore(p, ["tax_total"], where=F.col("is_train"))
    return z.select("id_parcel", "is_train", F.round("tax_total", 8).alias("tax_total"))


BOXCOX_SQL = with_(SALES) + """,
x AS (SELECT sale_key, price AS x FROM sales WHERE price > 0),
g AS (SELECT CAST(round(-2 + 0.1 * i, 1) AS DOUBLE) AS "lambda" FROM range(41) r(i)),
s AS (SELECT count(*) AS n, sum(ln(x)) AS sl FROM x),
prof AS (
  SELECT g."lambda", -0.5 * s.n * ln(var_pop(CASE WHEN g."lambda" = 0 THEN ln(x.x) ELSE pow(x.x, g."lambda") / g."lambda" END))
                   + (g."lambda" - 1) * s.sl AS loglik
  FROM g, x, s GROUP BY g."lambda", s.n, s.sl)"""


@register("boxcox_lambda", BOXCOX_SQL + '\nSELECT "lambda", round(loglik, 3) AS loglik FROM prof')
def boxcox_lambda(spark, sf):
    """Box-Cox profile log-likelihood over lambda -2..2 by 0.1 (one aggregate pass)."""
    prof = Z.boxcox_profile(S.sales(spark, sf), "price")
    return prof.select("lambda", F.round("loglik", 3).alias("loglik"))


@register("boxcox_apply", BOXCOX_SQL + """,
best AS (SELECT arg_max("lambda", loglik) AS b FROM prof),
lam AS (SELECT CASE WHEN abs(b) < 0.2 THEN 0.0 WHEN abs(b - 1) < 0.2 THEN 1.0 ELSE b END AS l FROM best),
t AS (SELECT sale_key, CASE WHEN l = 0 THEN ln(x) ELSE (pow(x, l) - 1) / l END AS t FROM x, lam)
SELECT sale_key, round((t - avg(t) OVER ()) / stddev_samp(t) OVER (), 6) AS price_bc FROM t""")
def boxcox_apply(spark, sf):
    """Transform by the chosen lambda, then centre and scale."""
    s = S.sales(spark, sf).select("sale_key", "price")
    out = Z.boxcox_apply(s, "price", out_col="price_bc")
    return out.select("sale_key", F.round("price_bc", 6).alias("price_bc"))


_FOLDED = with_(SALES, strata_cte("sales", "logerror", "sale_key", "folds")) + """,
folded AS (SELECT sale_key, CAST(rnk % 3 AS INTEGER) AS fold, price, quantity, flag FROM ranked),
fo AS (SELECT CAST(f AS INTEGER) AS fold FROM range(3) r(f)),
part AS (SELECT fo.fold, price, quantity, flag FROM fo JOIN folded ON folded.fold <> fo.fold),
"""


def _folded(spark, sf):
    s = S.sales(spark, sf).select("sale_key", "logerror", "price", "quantity", "flag")
    return stratified_folds(s, "logerror", "sale_key", 3)


@register("fold_statistics", _FOLDED + """
g AS (SELECT CAST(round(-2 + 0.1 * i, 1) AS DOUBLE) AS l FROM range(41) r(i)),
sums AS (SELECT fold, count(*) AS n, sum(ln(price)) AS sl FROM part GROUP BY fold),
prof AS (SELECT g.l, part.fold, -0.5 * sums.n * ln(var_pop(CASE WHEN g.l = 0 THEN ln(price) ELSE pow(price, g.l) / g.l END)) + (g.l - 1) * sums.sl AS loglik
         FROM part JOIN sums USING (fold), g GROUP BY g.l, part.fold, sums.n, sums.sl),
best AS (SELECT fold, arg_max(l, loglik) AS b FROM prof GROUP BY fold),
lev AS (SELECT fold, count(DISTINCT flag) AS n_levels FROM part GROUP BY fold)
SELECT fold, count(*) AS n, round(avg(price), 6) AS price_mean, round(stddev_samp(price), 6) AS price_sd, round(avg(quantity), 6) AS quantity_mean,
       round(stddev_samp(quantity), 6) AS quantity_sd, any_value(b) AS "lambda", any_value(n_levels) AS n_levels
FROM part JOIN best USING (fold) JOIN lev USING (fold) GROUP BY fold""")
def fold_statistics(spark, sf):
    """E8, E9, E1 inside CV: mean, sd, Box-Cox power and number of levels that each fold's model may know, in one pass by fold."""
    folded = _folded(spark, sf).cache()
    moments = {(f, c): (n, m, sd) for f, c, n, m, sd in L.excluded_moments(folded, ["price", "quantity"])}
    best = {}
    for f, lam, v in L.excluded_boxcox(folded, "price"):
        if v is not None and (f not in best or v > best[f][0]):
            best[f] = (v, lam)
    levels = {r.fold: r.n for r in L.excluded_levels(folded, "flag").groupBy("fold").agg(F.count("*").alias("n")).collect()}
    folded.unpersist()
    rows = [(f, n, m, sd, *moments[f, "quantity"][1:], best[f][1], levels.get(f, 0)) for (f, c), (n, m, sd) in moments.items() if c == "price"]
    out = spark.createDataFrame(rows, "fold int, n long, price_mean double, price_sd double, quantity_mean double, quantity_sd double, `lambda` double, n_levels long")
    return out.withColumns({c: F.round(c, 6) for c in ("price_mean", "price_sd", "quantity_mean", "quantity_sd")})


@register("fold_mean_fill", with_(PROPS, strata_cte("(SELECT id_parcel, build_year * 1.0 AS y, tax_total FROM props)", "y", "id_parcel", "folds")) + """,
f AS (SELECT id_parcel, CAST(rnk % 3 AS INTEGER) AS fold, tax_total FROM ranked),
m AS (SELECT o.fold, avg(f.tax_total) AS mean FROM (SELECT DISTINCT fold FROM f) o JOIN f ON f.fold <> o.fold GROUP BY o.fold)
SELECT id_parcel, fold, round(coalesce(tax_total, mean), 6) AS tax_total FROM f JOIN m USING (fold)""")
def fold_mean_fill(spark, sf):
    """I7 inside CV: a gap is filled by the mean of the rows outside of its own fold."""
    p = S.properties(spark, sf).select("id_parcel", F.col("build_year").cast("double").alias("y"), "tax_total")
    filled = L.excluded_fill(stratified_folds(p, "y", "id_parcel", 3), ["tax_total"])
    return filled.select("id_parcel", "fold", F.round("tax_total", 6).alias("tax_total"))


@register("level_dictionary", with_(SALES) + """, l AS (SELECT DISTINCT sale_key AS level FROM sales)
SELECT level, row_number() OVER (ORDER BY level) AS code FROM l""")
def level_dictionary_q(spark, sf):
    """Codes of a column with as many levels as rows, ranked over range partitions."""
    return level_dictionary(S.sales(spark, sf).select("sale_key"), "sale_key")
