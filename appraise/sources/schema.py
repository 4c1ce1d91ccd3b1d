"""Declared schemas and the property column names.

The reference lets its CSV reader infer types; here every scan has a fixed schema and
casts state their output type.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (must equal the reference's names) ---------------------------------------
# Property column renames, new name <- raw name, in the reference's order (50 pairs).
PROPERTY_RENAMES = (
    ("id_parcel", "parcelid"),
    ("build_year", "yearbuilt"),
    ("area_basement", "basementsqft"),
    ("area_patio", "yardbuildingsqft17"),
    ("area_shed", "yardbuildingsqft26"),
    ("area_pool", "poolsizesum"),
    ("area_lot", "lotsizesquarefeet"),
    ("area_garage", "garagetotalsqft"),
    ("area_firstfloor_finished", "finishedfloor1squarefeet"),
    ("area_total_calc", "calculatedfinishedsquarefeet"),
    ("area_base", "finishedsquarefeet6"),
    ("area_live_finished", "finishedsquarefeet12"),
    ("area_liveperi_finished", "finishedsquarefeet13"),
    ("area_total_finished", "finishedsquarefeet15"),
    ("area_unknown", "finishedsquarefeet50"),
    ("num_unit", "unitcnt"),
    ("num_story", "numberofstories"),
    ("num_room", "roomcnt"),
    ("num_bathroom", "bathroomcnt"),
    ("num_bedroom", "bedroomcnt"),
    ("num_bathroom_calc", "calculatedbathnbr"),
    ("num_bath", "fullbathcnt"),
    ("num_75_bath", "threequarterbathnbr"),
    ("num_fireplace", "fireplacecnt"),
    ("num_pool", "poolcnt"),
    ("num_garage", "garagecarcnt"),
    ("region_county", "regionidcounty"),
    ("region_city", "regionidcity"),
    ("region_zip", "regionidzip"),
    ("region_neighbor", "regionidneighborhood"),
    ("tax_total", "taxvaluedollarcnt"),
    ("tax_building", "structuretaxvaluedollarcnt"),
    ("tax_land", "landtaxvaluedollarcnt"),
    ("tax_property", "taxamount"),
    ("tax_year", "assessmentyear"),
    ("tax_delinquency", "taxdelinquencyflag"),
    ("tax_delinquency_year", "taxdelinquencyyear"),
    ("zoning_property", "propertyzoningdesc"),
    ("zoning_landuse", "propertylandusetypeid"),
    ("zoning_landuse_county", "propertycountylandusecode"),
    ("flag_fireplace", "fireplaceflag"),
    ("flag_tub", "hashottuborspa"),
    ("quality", "buildingqualitytypeid"),
    ("framing", "buildingclasstypeid"),
    ("material", "typeconstructiontypeid"),
    ("deck", "decktypeid"),
    ("story", "storytypeid"),
    ("heating", "heatingorsystemtypeid"),
    ("aircon", "airconditioningtypeid"),
    ("architectural_style", "architecturalstyletypeid"),
)
# Raw property columns that keep their names.
PROPERTY_KEPT = ("latitude", "longitude", "fips", "pooltypeid10", "pooltypeid2", "pooltypeid7",
                 "rawcensustractandblock", "censustractandblock")
# Columns set to -1 when missing before the whole-table -999 fill (second cleaning round).
SENTINEL_MINUS_ONE = ("aircon", "heating", "zoning_landuse", "region_county", "region_zip", "num_75_bath",
                      "flag_fireplace", "num_pool", "pooltypeid7", "num_story")
# Columns dropped after the sentinel fills (second cleaning round).
SENTINEL_DROP = ("architectural_style", "area_basement", "framing", "num_bathroom_calc", "deck",
                 "area_firstfloor_finished", "area_live_finished", "area_liveperi_finished", "area_total_finished",
                 "area_unknown", "area_base", "fips", "num_fireplace", "num_bath", "num_garage", "flag_tub",
                 "area_pool", "pooltypeid10", "pooltypeid2", "zoning_landuse_county", "zoning_property",
                 "rawcensustractandblock", "region_neighbor", "story", "material", "area_patio", "area_shed",
                 "tax_building", "tax_year", "tax_land", "tax_property", "tax_delinquency", "tax_delinquency_year",
                 "censustractandblock", "region_city")
# Columns turned into factors after the drop.
FACTOR_COLUMNS = ("aircon", "heating", "zoning_landuse", "region_county", "num_75_bath", "flag_fireplace",
                  "num_pool", "pooltypeid7", "num_story")
# ---- end of fixed values --------------------------------------------------------------------

RENAME_MAP = {raw: new for new, raw in PROPERTY_RENAMES}

_LONG = {"parcelid", "latitude", "longitude"}
_DOUBLE = {"basementsqft", "yardbuildingsqft17", "yardbuildingsqft26", "poolsizesum", "lotsizesquarefeet",
           "garagetotalsqft", "finishedfloor1squarefeet", "calculatedfinishedsquarefeet", "finishedsquarefeet6",
           "finishedsquarefeet12", "finishedsquarefeet13", "finishedsquarefeet15", "finishedsquarefeet50",
           "bathroomcnt", "calculatedbathnbr", "taxvaluedollarcnt", "structuretaxvaluedollarcnt",
           "landtaxvaluedollarcnt", "taxamount", "rawcensustractandblock", "censustractandblock"}
_STRING = {"fireplaceflag", "hashottuborspa", "taxdelinquencyflag", "propertyzoningdesc", "propertycountylandusecode"}


def _raw_type(name: str) -> T.DataType:
    if name in _LONG:
        return T.LongType()
    if name in _DOUBLE:
        return T.DoubleType()
    if name in _STRING:
        return T.StringType()
    return T.IntegerType()


PROPERTIES_RAW_SCHEMA = T.StructType(
    [T.StructField(raw, _raw_type(raw), raw != "parcelid") for _, raw in PROPERTY_RENAMES]
    + [T.StructField(c, _raw_type(c), True) for c in PROPERTY_KEPT])

SALES_RAW_SCHEMA = T.StructType([
    T.StructField("parcelid", T.LongType(), False),
    T.StructField("logerror", T.DoubleType(), True),
    T.StructField("transactiondate", T.DateType(), True),
])

LOOKUP_ZIP_SCHEMA = T.StructType([
    T.StructField("latitude", T.LongType(), True),
    T.StructField("longitude", T.LongType(), True),
    T.StructField("zip", T.IntegerType(), True),
])
