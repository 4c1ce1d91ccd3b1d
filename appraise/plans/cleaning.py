"""Cleaning and feature-table jobs: property repair, the sentinel round, the training frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.functions import rsem
from appraise.operators import columns as C
from appraise.operators import encode as E
from appraise.operators import impute as I
from appraise.operators.filters import trim_quantiles
from appraise.operators.sampling import stratified_folds
from appraise.plans.registry import register
from appraise.plans.sqltext import OFF_LIST, PROPS, SALES, with_
from appraise.sources import io
from appraise.sources import schema as SCH
from appraise.sources import standins as S

FEATURES = ["month", "tax_total", "zoning_code", "status_code", "build_year", "region_zip"]
PROPERTY_FEATURES = [c for c in FEATURES if c != "month"]


# ---- fixed values: the first cleaning round on the whole property table ----------------------
ROUND_ONE_CONSTANTS = {"aircon": 5, "heating": 13, "num_room": 0}
ROUND_ONE_MEANS = ("area_total_calc", "tax_total")
ROUND_ONE_DONORS = ("area_garage", "area_lot", "build_year", "longitude", "latitude", "region_county", "region_zip")
ROUND_ONE_ALLOWED_DONORS = {"quality": (1, 4, 7, 10), "num_unit": (1, 2, 3, 4), "num_bedroom": (3, 4, 2, 5),
                            "zoning_landuse": (261, 246, 266, 269), "num_bathroom": (1.0, 2.0, 3.0, 2.5)}
ROUND_ONE_PRESENCE = ("num_pool", "pooltypeid7", "num_75_bath")
ROUND_ONE_STORY_TAIL = (4, 41)
ROUND_ONE_DROP = ("architectural_style", "area_basement", "framing", "num_bathroom_calc", "deck",
                  "area_firstfloor_finished", "area_live_finished", "area_liveperi_finished", "area_total_finished",
                  "area_unknown", "area_base", "fips", "num_fireplace", "num_bath", "num_garage", "flag_tub",
                  "area_pool", "pooltypeid10", "pooltypeid2", "zoning_landuse_county", "zoning_property",
                  "rawcensustractandblock", "region_neighbor", "story", "material", "area_patio",
                  "area_shed", "tax_building", "tax_year", "tax_land", "tax_property", "tax_delinquency",
                  "tax_delinquency_year", "censustractandblock", "region_city")
# ---- end of fixed values --------------------------------------------------------------------


def round_one(props: DataFrame, id_col: str = "id_parcel", salt: str = "round1") -> DataFrame:
    """First cleaning round on a property table with the reference's column names: constant
    fills, the merged fireplace flag, stories (missing → 0, 4..41 → 'other'), presence flags,
    mean fills (one aggregate), random donors and donors from allowed value sets without
    replacement (one multi-column pass, ``hot_deck_many``), then the drop list."""
    p = I.fill_constant(props, ROUND_ONE_CONSTANTS)
    if "flag_fireplace" in p.columns and "num_fireplace" in p.columns:
        p = p.withColumn("flag_fireplace", rsem.merged_flag("num_fireplace", "flag_fireplace"))
    if "num_story" in p.columns:
        lo, hi = ROUND_ONE_STORY_TAIL
        p = p.withColumn("num_story", rsem.collapse_levels(F.coalesce(F.col("num_story"), F.lit(0)), lo, hi))
    p = I.presence_flags(p, ROUND_ONE_PRESENCE)
    p = I.impute_mean(p, ROUND_ONE_MEANS)
    specs = {c: (None, True) for c in ROUND_ONE_DONORS}
    specs.update({c: (allowed, False) for c, allowed in ROUND_ONE_ALLOWED_DONORS.items()})
    p = I.hot_deck_many(p, specs, id_col, salt=salt)
    return C.drop_columns(p, ROUND_ONE_DROP)


def sentinel_round(props: DataFrame, minus_one=SCH.SENTINEL_MINUS_ONE, drop=SCH.SENTINEL_DROP) -> DataFrame:
    """Second cleaning round on a property table with the reference's column names:
    NA → -1 for the categorical columns, every other NA → -999, then the drop list."""
    p = I.fill_sentinel(props, minus_one, -1)
    p = I.fill_all(p, -999, skip=["id_parcel"])
    return C.drop_columns(p, drop)


def read_raw_properties(spark, path: str) -> DataFrame:
    """Raw property CSV → declared types → the reference's column names; coordinates in degrees."""
    raw = io.read_csv(spark, path, SCH.PROPERTIES_RAW_SCHEMA)
    return C.scale_by(C.rename_columns(raw, SCH.RENAME_MAP), ["latitude", "longitude"], 1e6)


def clean_properties(spark, sf, fill: bool = True) -> DataFrame:
    """Stand-in properties repaired for modelling: zoning sentinel then level codes, mean-filled
    value, status codes. Without ``fill`` the value's gaps stay for the model to fill from its own training rows;
    with it no NULL is left in a feature column."""
    p = S.properties(spark, sf)
    p = I.fill_sentinel(p, ["zoning"])
    if fill:
        p = I.impute_mean(p, ["tax_total"])
    p = E.level_codes_many(p, {"zoning": ("zoning_code", -999), "status": ("status_code", None)})
    return p.select("id_parcel", *PROPERTY_FEATURES)


def model_frame(spark, sf, folds: int = 3, path: str | None = None) -> DataFrame:
    """Trimmed sales with month, joined to repaired properties, with stratified folds. No column holds a statistic of all
    rows: gaps stay, and a model fills them from the rows it is fitted on.
    Written once to the checkpoint folder: model selection reads it many times, and a lost
    executor then recomputes from these files, not from the raw scans. The written table keeps
    the stratum rank, so every fold count is a projection of the same table (fold = rank mod k): a
    caller that fits several models gives its own ``path`` and reads it again with ``read_frame``."""
    s = trim_quantiles(S.sales(spark, sf).select("sale_key", "id_parcel", "logerror", "transactiondate"), "logerror")
    s = s.withColumn("month", F.month("transactiondate")).drop("transactiondate")
    base = stratified_folds(s.join(clean_properties(spark, sf, fill=False), "id_parcel"), "logerror", "sale_key", folds,
                            rank_col="fold_rank").drop("fold")
    return _with_folds(io.checkpoint_table(base, "model_frame", path), folds)


def read_frame(spark, path: str, folds: int = 3) -> DataFrame:
    """The frame that an earlier ``model_frame(path=...)`` wrote, with any number of folds."""
    return _with_folds(spark.read.parquet(path), folds)


def _with_folds(base: DataFrame, folds: int) -> DataFrame:
    return base.withColumn("fold", (F.col("fold_rank") % F.lit(folds)).cast("int")).drop("fold_rank")


@register("feature_table", with_(PROPS, SALES, OFF_LIST) + """,
b AS (SELECT quantile_cont(logerror, 0.005) AS lo, quantile_cont(logerror, 0.995) AS hi FROM off_list),
t AS (SELECT s.id_parcel, s.sale_key, s.logerror, CAST(month(s.transactiondate) AS INTEGER) AS month
      FROM off_list s, b WHERE s.logerror BETWEEN b.lo AND b.hi),
p AS (SELECT id_parcel, region_zip, coalesce(tax_total, -999) AS tax_total, coalesce(zoning, '-1') AS zoning, build_year
      FROM props),
lv AS (SELECT zoning, dense_rank() OVER (ORDER BY zoning) AS dr FROM (SELECT DISTINCT zoning FROM p)),
pc AS (SELECT p.id_parcel, p.region_zip, p.tax_total, p.build_year,
              CAST(CASE WHEN lv.dr = 1 THEN -999 ELSE lv.dr - 1 END AS INTEGER) AS zoning_code
       FROM p JOIN lv USING (zoning))
SELECT t.id_parcel, t.sale_key, t.logerror, t.month, pc.region_zip, pc.tax_total, pc.build_year, pc.zoning_code
FROM pc RIGHT JOIN t ON pc.id_parcel = t.id_parcel""")
def feature_table(spark, sf):
    """The feature-table job end to end: trim and date parts on the sales; sentinel -1 on the
    category, -999 on every other gap, status dropped, level codes; right outer merge that
    keeps every sale (those of parcels that the property table does not list get NULL sides)."""
    s = trim_quantiles(S.sales_off_list(spark, sf).select("id_parcel", "sale_key", "logerror", "transactiondate"), "logerror")
    s = C.with_date_parts(s, "transactiondate").drop("year")
    p = sentinel_round(S.properties(spark, sf), minus_one=["zoning"], drop=["status"])
    p = E.level_codes(p, "zoning", "zoning_code", first_code=-999).drop("zoning")
    out = p.join(s, "id_parcel", "right")
    return out.select("id_parcel", "sale_key", "logerror", "month", "region_zip", "tax_total", "build_year", "zoning_code")
