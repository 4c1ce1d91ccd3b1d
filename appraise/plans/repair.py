"""Missing-value repair queries (inventory 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from appraise.functions import rsem
from appraise.operators import impute as I
from appraise.plans.registry import register
from appraise.plans.sqltext import LOCATED, PARTS, PROPS, SALES, h, with_
from appraise.sources import standins as S


def _props_split_tax(spark, sf):
    """Property stand-in with a building value and a land value, each with its own gaps."""
    o = S.table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("id_parcel"),
        F.col("o_totalprice").alias("tax_total"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("o_totalprice") * 0.6).alias("tax_building"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_totalprice") * 0.4).alias("tax_land"),
    )


SPLIT_TAX = """split_tax AS (
  SELECT o_orderkey AS id_parcel, o_totalprice AS tax_total,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice * 0.6 END AS tax_building,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice * 0.4 END AS tax_land
  FROM orders)"""


@register("fill_constant", with_(PROPS) + """
SELECT id_parcel, coalesce(tax_total, 5.0) AS tax_total, coalesce(zoning, '13') AS zoning FROM props""")
def fill_constant(spark, sf):
    """A constant per column (5 for no aircon, 13 for no heating, ...)."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total", "zoning")
    return I.fill_constant(p, {"tax_total": 5, "zoning": "13"})


@register("fill_zero_list", with_(PROPS) + """
SELECT id_parcel, coalesce(tax_total, 0) AS tax_total, region_zip, zoning FROM props""")
def fill_zero_list(spark, sf):
    """0 over a name list limited to the columns present."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total", "region_zip", "zoning")
    return I.fill_zero(p, ["tax_total", "region_zip", "num_garage", "area_patio"])


@register("fill_sentinel", with_(PROPS) + """
SELECT id_parcel, coalesce(tax_total, -1) AS tax_total, coalesce(zoning, '-1') AS zoning, status FROM props""")
def fill_sentinel(spark, sf):
    """Categorical sentinel -1 (text columns get '-1')."""
    p = S.properties(spark, sf).select("id_parcel", "tax_total", "zoning", "status")
    return I.fill_sentinel(p, ["tax_total", "zoning", "aircon"])


@register("fill_all_sentinel", with_(PROPS) + """
SELECT id_parcel, region_zip, coalesce(tax_total, -999) AS tax_total, coalesce(zoning, '-999') AS zoning,
       status, build_year FROM props""")
def fill_all_sentinel(spark, sf):
    """I4: every remaining missing cell → -999, numeric and text columns alike."""
    return I.fill_all(S.properties(spark, sf), -999)


@register("replace_sentinel", with_(PROPS) + """
SELECT id_parcel, region_zip, CASE WHEN t = -1 THEN -999 ELSE t END AS tax_total, build_year
FROM (SELECT id_parcel, region_zip, coalesce(tax_total, -1) AS t, build_year FROM props)""")
def replace_sentinel(spark, sf):
    """Sentinel rewrite over the whole table (-1 → -999)."""
    p = I.fill_sentinel(S.properties(spark, sf).select("id_parcel", "region_zip", "tax_total", "build_year"), ["tax_total"])
    return I.replace_value(p, -1, -999)


@register("presence_flag", with_(PROPS) + """
SELECT id_parcel, CAST(tax_total IS NOT NULL AS INTEGER) AS tax_total, CAST(zoning IS NOT NULL AS INTEGER) AS zoning
FROM props""")
def presence_flag(spark, sf):
    """NA → 0, present → 1."""
    return I.presence_flags(S.properties(spark, sf).select("id_parcel", "tax_total", "zoning"), ["tax_total", "zoning"])


@register("impute_mean", with_(PROPS) + """
SELECT id_parcel, round(coalesce(tax_total, (SELECT avg(tax_total) FROM props)), 6) AS tax_total FROM props""")
def impute_mean(spark, sf):
    """Mean of the present values fills the gaps."""
    p = I.impute_mean(S.properties(spark, sf).select("id_parcel", "tax_total"), ["tax_total"])
    return p.withColumn("tax_total", F.round("tax_total", 6))


@register("impute_hotdeck", with_(PROPS) + f""",
donors AS (SELECT tax_total AS v, row_number() OVER (ORDER BY {h('hotdeck:donor', 'id_parcel')}, id_parcel) - 1 AS slot
           FROM props WHERE tax_total IS NOT NULL),
nd AS (SELECT count(*) AS n FROM donors)
SELECT p.id_parcel, coalesce(p.tax_total, d.v) AS tax_total
FROM props p LEFT JOIN donors d
  ON p.tax_total IS NULL AND d.slot = {h('hotdeck:pick', 'p.id_parcel')} % (SELECT n FROM nd)""")
def impute_hotdeck(spark, sf):
    """I8: random hot-deck with replacement from all present values (repeatable draw by hash)."""
    return I.hot_deck(S.properties(spark, sf).select("id_parcel", "tax_total"), "tax_total", "id_parcel", salt="hotdeck")


@register("impute_hotdeck_restricted", with_(PARTS) + f""",
donors AS (SELECT size_gap AS v, row_number() OVER (ORDER BY {h('restricted:donor', 'p_partkey')}, p_partkey) - 1 AS slot
           FROM parts WHERE size_gap IN (1, 4, 7, 10)),
nd AS (SELECT count(*) AS n FROM donors),
gaps AS (SELECT p_partkey, row_number() OVER (ORDER BY {h('restricted:pick', 'p_partkey')}, p_partkey) - 1 AS grank
         FROM parts WHERE size_gap IS NULL)
SELECT p.p_partkey, coalesce(p.size_gap, d.v) AS size_filled
FROM parts p LEFT JOIN gaps g ON p.p_partkey = g.p_partkey
LEFT JOIN donors d ON d.slot = g.grank % (SELECT n FROM nd)""")
def impute_hotdeck_restricted(spark, sf):
    """Donors limited to an allowed value set, drawn without replacement
    (``sample(x[x %in% S], n_gaps)``); extra gaps reuse donors and are counted."""
    p = S.parts(spark, sf).select("p_partkey", "size_gap")
    out = I.hot_deck(p, "size_gap", "p_partkey", salt="restricted", replace=False,
                     donor_filter=F.col("size_gap").isin(1, 4, 7, 10), out_col="size_filled")
    return out.select("p_partkey", "size_filled")


@register("na_category", with_(PROPS) + "SELECT id_parcel, coalesce(zoning, '__NA__') AS zoning, status FROM props")
def na_category(spark, sf):
    """Missing as a level of its own."""
    return I.na_category(S.properties(spark, sf).select("id_parcel", "zoning", "status"), ["zoning", "status", "deck"])


@register("fill_conditional", with_(SPLIT_TAX) + """
SELECT id_parcel, CASE WHEN tax_building IS NULL AND tax_land IS NOT NULL THEN 0 ELSE tax_building END AS tax_building
FROM split_tax""")
def fill_conditional(spark, sf):
    """Missing building value → 0 where the land value is present."""
    t = _props_split_tax(spark, sf)
    return t.select("id_parcel", rsem.fill_when_other_present("tax_building", "tax_land", 0.0).alias("tax_building"))


@register("fill_identity", with_(SPLIT_TAX) + """
SELECT id_parcel, coalesce(tax_building, tax_total - tax_land) AS tax_building FROM split_tax""")
def fill_identity(spark, sf):
    """building = total - land where building is missing."""
    t = _props_split_tax(spark, sf)
    return t.select("id_parcel", rsem.fill_by_identity("tax_building", "tax_total", "tax_land").alias("tax_building"))


def zip_lookup(spark, sf):
    """The lookup file of known (lat, lon) → zip, derived from the located rows that have one."""
    return S.located(spark, sf).where(F.col("zip").isNotNull()).select("lat", "lon", "zip").distinct()


@register("lookup_fill", with_(LOCATED) + """,
lk AS (SELECT lat, lon, max(zip) AS zip FROM located WHERE zip IS NOT NULL GROUP BY lat, lon)
SELECT l.c_custkey, l.lat, l.lon, coalesce(l.zip, lk.zip) AS zip
FROM located l LEFT JOIN lk ON l.zip IS NULL AND l.lat = lk.lat AND l.lon = lk.lon""")
def lookup_fill(spark, sf):
    """Missing zip filled from a lookup on two exact keys (broadcast behind a row bound)."""
    return I.fill_lookup(S.located(spark, sf), zip_lookup(spark, sf), ["lat", "lon"], "zip", "zip")


@register("missing_keys", with_(LOCATED) + "SELECT DISTINCT lat, lon FROM located WHERE zip IS NULL")
def missing_keys(spark, sf):
    """Distinct coordinates that still need a lookup."""
    return I.missing_keys(S.located(spark, sf), ["lat", "lon"], "zip")


def _sales_with_gaps(spark, sf):
    s = S.sales(spark, sf)
    return s.select("sale_key",
                    F.when(F.col("linenumber") == 3, F.lit(None)).otherwise(F.col("quantity")).alias("quantity"),
                    F.when(F.col("linenumber") == 5, F.lit(None))
                    .otherwise(F.col("price") / F.lit(1000.0)).alias("price_k"))


def _multi_sql() -> str:
    def column(c: str, allowed: str | None, replace: bool) -> str:
        cond = f"{c} IS NOT NULL" + (f" AND {c} IN ({allowed})" if allowed else "")
        pick = (f"{h(f'multi:{c}:pick', 'sale_key')} % (SELECT n FROM n_{c})" if replace else
                f"(row_number() OVER (ORDER BY {h(f'multi:{c}:pick', 'sale_key')}, sale_key) - 1) % (SELECT n FROM n_{c})")
        return f"""d_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {h(f'multi:{c}:donor', 'sale_key')}, sale_key) - 1 AS slot
                FROM g WHERE {cond}),
n_{c} AS (SELECT count(*) AS n FROM d_{c}),
p_{c} AS (SELECT sale_key, {pick} AS slot FROM g WHERE {c} IS NULL),
f_{c} AS (SELECT p.sale_key, d.v FROM p_{c} p JOIN d_{c} d USING (slot))"""
    return with_(SALES) + f""",
g AS (SELECT sale_key, CASE WHEN linenumber = 3 THEN NULL ELSE quantity END AS quantity,
             CASE WHEN linenumber = 5 THEN NULL ELSE price / 1000.0 END AS price_k FROM sales),
{column('quantity', '1, 4, 7, 10', False)},
{column('price_k', None, True)}
SELECT g.sale_key, coalesce(g.quantity, fq.v) AS quantity, coalesce(g.price_k, fp.v) AS price_k
FROM g LEFT JOIN f_quantity fq USING (sale_key) LEFT JOIN f_price_k fp USING (sale_key)"""


@register("impute_hotdeck_multi", _multi_sql())
def impute_hotdeck_multi(spark, sf):
    """I8 + I9 over several columns in one pass: quantity from the allowed set {1, 4, 7, 10}
    without replacement, the value from all donors with replacement."""
    g = _sales_with_gaps(spark, sf)
    return I.hot_deck_many(g, {"quantity": ((1, 4, 7, 10), False), "price_k": (None, True)}, "sale_key", salt="multi")
