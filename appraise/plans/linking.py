"""Join queries (inventory 2.5) and the flagship feature query."""

from __future__ import annotations

from pyspark.sql import functions as F

from appraise.functions import rsem
from appraise.functions.numeric import fixed_mean
from appraise.operators import columns as C
from appraise.operators import impute as I
from appraise.operators import joins as J
from appraise.operators.filters import trim_quantiles
from appraise.operators.profile import group_count_desc
from appraise.operators.score import SUBMISSION_MONTHS
from appraise.plans.registry import register
from appraise.plans.sqltext import OFF_LIST, PROPS, SALES, with_
from appraise.sources import standins as S


@register("join_inner", with_(PROPS, SALES) + """
SELECT s.sale_key, s.id_parcel, s.logerror, p.tax_total, p.zoning FROM sales s JOIN props p USING (id_parcel)""")
def join_inner(spark, sf):
    """Sale facts inner-joined to property attributes; parcels holding over 1 % of all sales
    are split over salts (``skew_join``), so no task holds a hot parcel's sales."""
    s = S.sales(spark, sf).select("sale_key", "id_parcel", "logerror")
    p = S.properties(spark, sf).select("id_parcel", "tax_total", "zoning")
    return J.skew_join(s, p, "id_parcel", "inner", hot_share=0.01)


@register("join_right_outer", with_(PROPS, SALES, OFF_LIST) + """
SELECT s.id_parcel, p.tax_total, p.status, s.sale_key, s.logerror
FROM props p RIGHT JOIN off_list s ON p.id_parcel = s.id_parcel""")
def join_right_outer(spark, sf):
    """Every sale kept; sales of parcels that the property table does not list get NULL sides."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total", "status")
    s = S.sales_off_list(spark, sf).select("id_parcel", "sale_key", "logerror")
    return J.join_facts(s, p, "id_parcel", "right").select("id_parcel", "tax_total", "status", "sale_key", "logerror")


@register("join_right_prefix", with_(PROPS, SALES) + """
SELECT s.id_parcel, p.tax_total, p.status, s.sale_key, s.status AS i_status, s.logerror
FROM props p RIGHT JOIN (SELECT id_parcel, sale_key, linestatus AS status, logerror FROM sales) s
  ON p.id_parcel = s.id_parcel""")
def join_right_prefix(spark, sf):
    """Keyed join keeping every right row; clashing right names get the prefix ``i_``."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total", "status")
    s = S.sales(spark, sf).select("id_parcel", "sale_key", F.col("linestatus").alias("status"), "logerror")
    return J.right_join_prefixed(p, s, "id_parcel", "i_")


_MONTH_VALUES = ", ".join(f"({code}, '{label}')" for code, label in SUBMISSION_MONTHS)


@register("cross_months", with_(PROPS) + f"""
SELECT p.id_parcel, p.tax_total, CAST(m.code AS INTEGER) AS month, m.label
FROM props p, (VALUES {_MONTH_VALUES}) m(code, label)""")
def cross_months(spark, sf):
    """Every property once per scoring month (local explode, no join)."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total")
    return J.cross_months(p, SUBMISSION_MONTHS, "month", "label")


FLAGSHIP_SQL = with_(PROPS, SALES) + """,
b AS (SELECT quantile_cont(logerror, 0.005) AS lo, quantile_cont(logerror, 0.995) AS hi FROM sales),
t AS (SELECT s.* FROM sales s, b WHERE s.logerror BETWEEN b.lo AND b.hi),
j AS (SELECT t.*, p.tax_total FROM t JOIN props p USING (id_parcel)),
f AS (SELECT CAST(year(transactiondate) AS INTEGER) AS year, CAST(month(transactiondate) AS INTEGER) AS month,
             logerror, coalesce(tax_total, (SELECT avg(tax_total) FROM j)) AS tax_total,
             price / nullif(quantity - 25, 0) AS price_per_unit FROM j)
SELECT year, month, count(*) AS n_sales, sum(CAST(round(logerror * 1e6) AS BIGINT)) / count(logerror) / 1e6 AS mean_logerror,
       round(avg(tax_total), 4) AS mean_tax_total, round(avg(price_per_unit), 4) AS mean_price_per_unit
FROM f GROUP BY year, month"""


def flagship_frame(spark, sf):
    """Trim the target to its 0.5-99.5 % quantiles, join to properties, take date parts,
    mean-fill the property value, derive the ratio feature."""
    s = trim_quantiles(S.sales(spark, sf), "logerror", 0.005, 0.995)
    j = J.join_facts(s, S.properties(spark, sf).select("id_parcel", "tax_total"), "id_parcel", "inner")
    j = C.with_date_parts(j, "transactiondate")
    j = I.impute_mean(j, ["tax_total"])
    return j.withColumn("price_per_unit", rsem.safe_ratio("price", F.col("quantity") - 25))


@register("flagship", FLAGSHIP_SQL)
def flagship(spark, sf):
    """The minimum slice end to end: trim, join, date parts, mean fill, ratio, aggregate by month."""
    f = flagship_frame(spark, sf)
    return f.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_sales"), fixed_mean("logerror", 6).alias("mean_logerror"),
        F.round(F.avg("tax_total"), 4).alias("mean_tax_total"),
        F.round(F.avg("price_per_unit"), 4).alias("mean_price_per_unit"))


@register("group_count_desc", with_(SALES) + """
SELECT flag, linestatus, count(*) AS count FROM sales GROUP BY flag, linestatus ORDER BY count DESC, flag, linestatus""")
def group_count_desc_q(spark, sf):
    """A1: group counts, largest first."""
    return group_count_desc(S.sales(spark, sf), ["flag", "linestatus"])
