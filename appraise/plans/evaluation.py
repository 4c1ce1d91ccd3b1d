"""Evaluation and scoring-output queries (inventory 2.6 A7-A11 and 2.9).

Prediction pairs without a fitted model: obs = logerror, pred = the mean logerror of the
row's return-flag group. They have an exact SQL oracle. The CV tables use a one-parameter
predictor, ``alpha * group mean + (1 - alpha) * overall mean``, both taken from the other
folds, evaluated on three stratified folds: a parameter grid x folds table from the data.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from appraise.functions import rsem
from appraise.functions.numeric import fixed_mean
from appraise.operators import evaluate as V
from appraise.operators import sampling as R
from appraise.operators.joins import broadcast_small
from appraise.operators.score import alias_months, repeat_columns
from appraise.plans.registry import register
from appraise.plans.sqltext import SALES, strata_cte, with_
from appraise.sources import standins as S

ALPHAS = [0.0, 0.25, 0.5, 0.75, 1.0]


def group_mean_predictions(spark, sf):
    """(sale_key, flag, obs, pred): pred = group mean, joined from a small aggregated table."""
    s = S.sales(spark, sf).select("sale_key", "flag", "logerror")
    # one row per flag level: computed once, broadcast behind a row bound (a low-cardinality key
    # holds a third of the rows each, so a shuffled join here would be three hot tasks)
    means = broadcast_small(s.groupBy("flag").agg(F.avg("logerror").alias("pred")), 100_000)
    return s.join(means, "flag").select("sale_key", "flag", F.col("logerror").alias("obs"), "pred")


PAIRS = with_(SALES) + """,
pairs AS (SELECT s.sale_key, s.flag, s.logerror AS obs, m.pred
          FROM sales s JOIN (SELECT flag, avg(logerror) AS pred FROM sales GROUP BY flag) m USING (flag))"""


@register("mae", PAIRS + "\nSELECT round(avg(abs(obs - pred)), 10) AS mae, count(*) AS n FROM pairs")
def mae(spark, sf):
    """V1: mean absolute error (the reference's own summary function)."""
    m = V.error_metrics(group_mean_predictions(spark, sf))
    return m.select(F.round("mae", 10).alias("mae"), "n")


@register("mse", PAIRS + "\nSELECT round(avg(pow(obs - pred, 2)), 10) AS mse FROM pairs")
def mse(spark, sf):
    """V2: mean squared error."""
    return V.error_metrics(group_mean_predictions(spark, sf)).select(F.round("mse", 10).alias("mse"))


@register("corr_obs_pred", PAIRS + "\nSELECT round(corr(obs, pred), 8) AS corr FROM pairs")
def corr_obs_pred(spark, sf):
    """Pearson correlation of observed and predicted."""
    return V.error_metrics(group_mean_predictions(spark, sf)).select(F.round("corr", 8).alias("corr"))


SIGNS = PAIRS + """,
signs AS (SELECT CASE WHEN obs <= 0 THEN 0 ELSE 1 END AS obs, CASE WHEN pred <= 0 THEN 0 ELSE 1 END AS pred FROM pairs)"""


def sign_pairs(spark, sf):
    p = group_mean_predictions(spark, sf)
    return p.select(rsem.sign_label("obs").alias("obs"), rsem.sign_label("pred").alias("pred"))


@register("confusion_matrix", SIGNS + """
SELECT obs, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1
FROM signs GROUP BY obs""")
def confusion_matrix(spark, sf):
    """Two-way table of observed x predicted sign."""
    return V.confusion(sign_pairs(spark, sf), "obs", "pred", [0, 1])


KAPPA_SQL = SIGNS + """,
k AS (SELECT count(*) AS n, avg(CAST(obs = pred AS DOUBLE)) AS acc, avg(CAST(obs AS DOUBLE)) AS po,
             avg(CAST(pred AS DOUBLE)) AS pp FROM signs)"""


@register("accuracy", KAPPA_SQL + "\nSELECT n, round(acc, 10) AS accuracy FROM k")
def accuracy(spark, sf):
    """V4: share of matching labels."""
    return V.accuracy_kappa(sign_pairs(spark, sf)).select("n", F.round("accuracy", 10).alias("accuracy"))


@register("kappa", KAPPA_SQL + """
SELECT round((acc - (po * pp + (1 - po) * (1 - pp))) / (1 - (po * pp + (1 - po) * (1 - pp))), 10) AS kappa FROM k""")
def kappa(spark, sf):
    """V5: Cohen's kappa from the same counts."""
    return V.accuracy_kappa(sign_pairs(spark, sf)).select(F.round("kappa", 10).alias("kappa"))


# ---- CV table of the shrunken group mean -------------------------------------------------

def fold_errors(spark, sf):
    """(alpha, fold, mae): each fold scored by means of the other two folds; alphas x folds rows.
    One aggregate holds all alphas side by side, so the rows are not copied per alpha."""
    s = S.sales(spark, sf).select("sale_key", "flag", "logerror")
    folded = R.stratified_folds(s, "logerror", "sale_key", 3).select("fold", "flag", "logerror")
    st = folded.groupBy("fold", "flag").agg(F.sum("logerror").alias("sfg"), F.count(F.lit(1)).alias("nfg"))
    flag_tot = st.groupBy("flag").agg(F.sum("sfg").alias("sg"), F.sum("nfg").alias("ng"))
    fold_tot = st.groupBy("fold").agg(F.sum("sfg").alias("sf"), F.sum("nfg").alias("nf"))
    # st has (folds x flag levels) rows: the overall totals are a window over that small table
    everything = Window.partitionBy()
    excl = (st.join(flag_tot, "flag").join(fold_tot, "fold")
            .withColumns({"sa": F.sum("sfg").over(everything), "na": F.sum("nfg").over(everything)})
            .select("fold", "flag",
                    ((F.col("sg") - F.col("sfg")) / (F.col("ng") - F.col("nfg"))).alias("m_group"),
                    ((F.col("sa") - F.col("sf")) / (F.col("na") - F.col("nf"))).alias("m_all")))
    rows = folded.join(broadcast_small(excl, 100_000), ["fold", "flag"])
    def error(a):
        return F.avg(F.abs(F.col("logerror") - (F.lit(a) * F.col("m_group") + F.lit(1.0 - a) * F.col("m_all"))))

    wide = rows.groupBy("fold").agg(*[F.struct(F.lit(a).alias("alpha"), error(a).alias("mae")).alias(f"a{i}") for i, a in enumerate(ALPHAS)])
    return wide.select("fold", F.explode(F.array(*[f"a{i}" for i in range(len(ALPHAS))])).alias("r")).select("r.alpha", "fold", "r.mae")


_ALPHA_VALUES = ", ".join(f"({a})" for a in ALPHAS)

FOLD_ERRORS_SQL = with_(SALES, strata_cte("sales", "logerror", "sale_key", "folds")) + f""",
folded AS (SELECT sale_key, flag, logerror, CAST(rnk % 3 AS INTEGER) AS fold FROM ranked),
st AS (SELECT fold, flag, sum(logerror) AS sfg, count(*) AS nfg FROM folded GROUP BY fold, flag),
fl AS (SELECT flag, sum(sfg) AS sg, sum(nfg) AS ng FROM st GROUP BY flag),
fo AS (SELECT fold, sum(sfg) AS sf, sum(nfg) AS nf FROM st GROUP BY fold),
al AS (SELECT sum(sfg) AS sa, sum(nfg) AS na FROM st),
ex AS (SELECT st.fold, st.flag, (sg - sfg) / (ng - nfg) AS m_group, (sa - sf) / (na - nf) AS m_all
       FROM st JOIN fl USING (flag) JOIN fo USING (fold), al),
fe AS (SELECT a.alpha, f.fold, avg(abs(f.logerror - (a.alpha * e.m_group + (1 - a.alpha) * e.m_all))) AS mae
       FROM folded f JOIN ex e USING (fold, flag), (VALUES {_ALPHA_VALUES}) a(alpha)
       GROUP BY a.alpha, f.fold)"""


@register("cv_metric_table", FOLD_ERRORS_SQL + """
SELECT CAST(alpha AS DOUBLE) AS alpha, round(avg(mae), 8) AS mae_mean, round(stddev_samp(mae), 8) AS mae_sd,
       count(*) AS folds FROM fe GROUP BY alpha""")
def cv_metric_table(spark, sf):
    """V3: per parameter value, mean and sd of the fold MAE."""
    t = V.cv_metric_table(fold_errors(spark, sf), ["alpha"])
    return t.select("alpha", F.round("mae_mean", 8).alias("mae_mean"), F.round("mae_sd", 8).alias("mae_sd"), "folds")


@register("resample_summary", FOLD_ERRORS_SQL + """
SELECT CAST(alpha AS DOUBLE) AS alpha, round(min(mae), 8) AS min, round(quantile_cont(mae, 0.25), 8) AS q1,
       round(quantile_cont(mae, 0.5), 8) AS median, round(avg(mae), 8) AS mean, round(quantile_cont(mae, 0.75), 8) AS q3,
       round(max(mae), 8) AS max, count(*) FILTER (WHERE mae IS NULL) AS n_missing
FROM fe GROUP BY alpha""")
def resample_summary(spark, sf):
    """A10: min / quartiles / mean / max / missing of the fold metric per model setting."""
    t = V.resample_summary(fold_errors(spark, sf), "alpha")
    return t.select("alpha", *[F.round(c, 8).alias(c) for c in ["min", "q1", "median", "mean", "q3", "max"]], "n_missing")


@register("argmin_param", FOLD_ERRORS_SQL + """
SELECT CAST(alpha AS DOUBLE) AS alpha, round(mae_mean, 8) AS mae_mean
FROM (SELECT alpha, avg(mae) AS mae_mean FROM fe GROUP BY alpha) ORDER BY mae_mean, alpha LIMIT 1""")
def argmin_param(spark, sf):
    """The parameter row with the smallest mean error."""
    t = V.cv_metric_table(fold_errors(spark, sf), ["alpha"])
    best = V.argmin_row(t, "mae_mean", ["alpha"])
    return best.select("alpha", F.round("mae_mean", 8).alias("mae_mean"))


# ---- wide scoring outputs ----------------------------------------------------------------

MONTH_NAMES = [f"m{m:02d}" for m in range(1, 13)]
# exact mean of the 6-decimal target: BIGINT micro-units summed, then divided
_SQL_MEAN = "sum(CAST(round(logerror * 1e6) AS BIGINT))"


@register("pivot_months", with_(SALES) + "\nSELECT id_parcel, " + ", ".join(
    f"{_SQL_MEAN} FILTER (WHERE month(transactiondate) = {m}) / count(logerror) FILTER (WHERE month(transactiondate) = {m}) / 1e6 AS m{m:02d}"
    for m in range(1, 13))
    + " FROM sales GROUP BY id_parcel")
def pivot_months_q(spark, sf):
    """C2 (the pivot): long (id, month, value) → one column per month, fixed month list."""
    month = F.month("transactiondate")
    cells = [fixed_mean(F.when(month == m, F.col("logerror")), 6).alias(n) for m, n in zip(range(1, 13), MONTH_NAMES)]
    return S.sales(spark, sf).groupBy("id_parcel").agg(*cells)


LABELS = ["201610", "201611", "201612", "201710", "201711", "201712"]


@register("repeat_columns", with_(SALES) + "\nSELECT id_parcel, " + ", ".join(
    f"{_SQL_MEAN} / count(logerror) / 1e6 AS \"{lbl}\"" for lbl in LABELS) + " FROM sales GROUP BY id_parcel")
def repeat_columns_q(spark, sf):
    """One prediction per parcel repeated in every month column."""
    p = S.sales(spark, sf).groupBy("id_parcel").agg(fixed_mean("logerror", 6).alias("pred"))
    return repeat_columns(p, "id_parcel", "pred", LABELS)


@register("alias_months", with_(SALES) + """,
w AS (SELECT id_parcel, """ + ", ".join(
    f"{_SQL_MEAN} FILTER (WHERE month(transactiondate) = {m}) / count(logerror) FILTER (WHERE month(transactiondate) = {m}) / 1e6 AS \"2016{m}\""
    for m in (10, 11, 12))
    + """ FROM sales GROUP BY id_parcel)
SELECT id_parcel, "201610", "201611", "201612", "201610" AS "201710", "201611" AS "201711", "201612" AS "201712" FROM w""")
def alias_months_q(spark, sf):
    """C4: the 2017 columns reuse the 2016 ones; final header order."""
    month = F.month("transactiondate")
    cells = [fixed_mean(F.when(month == m, F.col("logerror")), 6).alias(f"2016{m}") for m in (10, 11, 12)]
    wide = S.sales(spark, sf).groupBy("id_parcel").agg(*cells)
    return alias_months(wide, "id_parcel", {"201610": "201610", "201611": "201611", "201612": "201612",
                                            "201710": "201610", "201711": "201611", "201712": "201612"})
