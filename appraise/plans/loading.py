"""Scans, sinks, projections, derived columns and filters (inventory 2.1 and 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.functions import rsem
from appraise.operators import columns as C
from appraise.operators.filters import drop_incomplete, trim_quantiles
from appraise.operators.inference import infer
from appraise.plans.registry import register
from appraise.plans.sqltext import LOCATED, PARTS, PROPS, SALES, h, with_
from appraise.session import scratch_path
from appraise.sources import io
from appraise.sources import standins as S

PROPS_SCHEMA = T.StructType([
    T.StructField("id_parcel", T.LongType()), T.StructField("region_zip", T.LongType()),
    T.StructField("tax_total", T.DoubleType()), T.StructField("zoning", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("build_year", T.IntegerType()),
])


@register("scan_orders", with_(PROPS) + "SELECT * FROM props")
def scan_orders(spark, sf):
    """Property table written as header CSV (missing = empty field), scanned back with a
    declared schema and ``nullValue=''``."""
    path = scratch_path(spark, "scan_orders_csv")
    S.properties(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return io.read_csv(spark, path, PROPS_SCHEMA)


@register("project_positional", with_(PROPS) + "SELECT region_zip, tax_total, zoning, status, build_year FROM props")
def project_positional(spark, sf):
    """Drop the first (id) column by position."""
    return C.drop_positional(S.properties(spark, sf), [0])


@register("typed_cast", with_(PARTS) + """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, TRY_CAST(size_text AS INTEGER) AS p_size,
       TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS p_retailprice FROM parts""")
def typed_cast(spark, sf):
    """A table of text columns given its declared types (tolerant: bad text → NULL)."""
    text = S.parts(spark, sf).select(F.col("p_partkey").cast("string").alias("p_partkey"),
                                     F.col("size_text").alias("p_size"),
                                     F.col("p_retailprice").cast("string").alias("p_retailprice"))
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_size", T.IntegerType()),
                           T.StructField("p_retailprice", T.DoubleType())])
    return C.cast_to_schema(text, schema)


@register("checkpoint_roundtrip", with_(PROPS) + "SELECT * FROM props")
def checkpoint_roundtrip(spark, sf):
    """Stage result written to parquet in the shared checkpoint folder and read back."""
    return io.checkpoint_table(S.properties(spark, sf), "props_stage")


@register("format_ids", with_(PROPS) + """
SELECT id_parcel, CAST(CAST(CAST(id_parcel * 1000 AS DOUBLE) AS BIGINT) AS VARCHAR) AS id_text FROM props""")
def format_ids(spark, sf):
    """Ids held as doubles printed as plain digits (``12000000``, never ``1.2E7``)."""
    p = S.properties(spark, sf)
    return p.select("id_parcel", C.id_text((F.col("id_parcel") * 1000).cast("double")).alias("id_text"))


@register("rename_map", """
SELECT o_orderkey AS id_parcel, o_custkey AS region_zip, o_orderstatus AS status, o_totalprice AS tax_total,
       CAST(o_orderdate AS DATE) AS build_date, o_orderpriority AS zoning FROM orders""")
def rename_map(spark, sf):
    """Bulk rename by a map (names the table lacks are ignored)."""
    o = S.table(spark, sf, "orders")
    mapping = {"o_orderkey": "id_parcel", "o_custkey": "region_zip", "o_totalprice": "tax_total",
               "o_orderpriority": "zoning", "o_orderstatus": "status", "o_orderdate": "build_date",
               "parcelid_not_here": "unused"}
    out = C.rename_columns(o, mapping)
    return out.withColumn("build_date", F.col("build_date").cast("date"))


@register("drop_columns", with_(PROPS) + "SELECT id_parcel, region_zip, tax_total, zoning FROM props")
def drop_columns(spark, sf):
    """Drop a name list, absent names ignored."""
    return C.drop_columns(S.properties(spark, sf), ["status", "build_year", "fips", "censustractandblock"])


@register("project_common", with_(PROPS) + "SELECT id_parcel, tax_total, zoning FROM props")
def project_common(spark, sf):
    """The property columns that the training frame also has."""
    props = S.properties(spark, sf)
    frame = S.sales(spark, sf).join(props.select("id_parcel", "tax_total", "zoning"), "id_parcel")
    return C.common_columns(props, frame)


@register("project_numeric", with_(PROPS) + "SELECT id_parcel, region_zip, tax_total, build_year FROM props")
def project_numeric(spark, sf):
    """Numeric columns only."""
    return C.numeric_columns(S.properties(spark, sf))


@register("date_parts", with_(SALES) + """
SELECT sale_key, id_parcel, logerror, CAST(year(transactiondate) AS INTEGER) AS year,
       CAST(month(transactiondate) AS INTEGER) AS month FROM sales""")
def date_parts(spark, sf):
    """Year and month of the sale date, date dropped."""
    s = S.sales(spark, sf).select("sale_key", "id_parcel", "logerror", "transactiondate")
    return C.with_date_parts(s, "transactiondate")


@register("scale_const", with_(LOCATED) + """
SELECT c_custkey, CAST(c_custkey * 1000 + lon AS BIGINT) / 1e6 AS latitude FROM located""")
def scale_const(spark, sf):
    """Coordinates in 1e-6 degrees divided by 1e6."""
    c = S.located(spark, sf).select("c_custkey", (F.col("c_custkey") * 1000 + F.col("lon")).alias("latitude"))
    return C.scale_by(c, ["latitude"], 1e6)


@register("ratio_feature", with_(SALES) + """
SELECT sale_key, price / nullif(quantity - 25, 0) AS price_per_unit FROM sales""")
def ratio_feature(spark, sf):
    """P10: value per area; a zero divisor gives NULL (R: Inf/NaN; ANSI '/' would raise)."""
    s = S.sales(spark, sf)
    return s.select("sale_key", rsem.safe_ratio("price", F.col("quantity") - 25).alias("price_per_unit"))


@register("const_column", with_(SALES) + "SELECT sale_key, CAST(1 AS INTEGER) AS year, CAST(10 AS INTEGER) AS month FROM sales")
def const_column(spark, sf):
    """Constant columns (year = 1, month = 10 at scoring)."""
    return S.sales(spark, sf).select("sale_key", F.lit(1).alias("year"), F.lit(10).alias("month"))


@register("random_category", with_(PROPS) + f"""
SELECT id_parcel, CAST(1 + {h('month', 'id_parcel')} % 12 AS INTEGER) AS month FROM props""")
def random_category(spark, sf):
    """A repeatable random month 1..12 per row."""
    return S.properties(spark, sf).select("id_parcel", C.random_category("id_parcel", 12, "month").alias("month"))


@register("abs_target", with_(SALES) + "SELECT sale_key, abs(logerror) AS abs_logerror FROM sales")
def abs_target(spark, sf):
    """Absolute-value target."""
    return S.sales(spark, sf).select("sale_key", F.abs("logerror").alias("abs_logerror"))


@register("sign_label", with_(SALES) + """
SELECT sale_key, CASE WHEN lg <= 0 THEN 0 WHEN lg > 0 THEN 1 END AS sign
FROM (SELECT sale_key, CASE WHEN linenumber = 7 THEN NULL ELSE logerror END AS lg FROM sales)""")
def sign_label(spark, sf):
    """Sign label (<= 0 → 0, else 1), missing kept missing."""
    s = S.sales(spark, sf).withColumn("lg", F.when(F.col("linenumber") == 7, F.lit(None)).otherwise(F.col("logerror")))
    return s.select("sale_key", rsem.sign_label("lg").alias("sign"))


@register("round_pred", with_(SALES) + """
SELECT s.sale_key, round_even(m.pred, 4) AS pred
FROM sales s JOIN (SELECT flag, avg(logerror) AS pred FROM sales GROUP BY flag) m USING (flag)""")
def round_pred(spark, sf):
    """Predictions rounded to 4 places, half to even (R ``round``)."""
    from appraise.plans.evaluation import group_mean_predictions
    return group_mean_predictions(spark, sf).select("sale_key", F.bround("pred", 4).alias("pred"))


@register("try_cast_numeric", with_(PARTS) + "SELECT p_partkey, TRY_CAST(size_text AS DOUBLE) AS size_num FROM parts")
def try_cast_numeric(spark, sf):
    """Text to number, unparsable text ('other') → NULL."""
    return S.parts(spark, sf).select("p_partkey", rsem.tolerant_number("size_text").alias("size_num"))


@register("trim_quantiles", with_(SALES) + """
SELECT sale_key, logerror FROM sales
WHERE logerror BETWEEN (SELECT quantile_cont(logerror, 0.005) FROM sales)
                   AND (SELECT quantile_cont(logerror, 0.995) FROM sales)""")
def trim_quantiles_q(spark, sf):
    """F1: keep the target between its 0.5 % and 99.5 % sample quantiles (ends included)."""
    return trim_quantiles(S.sales(spark, sf).select("sale_key", "logerror"), "logerror", 0.005, 0.995)


@register("filter_isin", with_(PARTS) + """
SELECT p_partkey, coalesce(size_gap IN (1, 4, 7, 10), false) AS is_member FROM parts""")
def filter_isin(spark, sf):
    """membership in a value set; a missing value is not a member."""
    return S.parts(spark, sf).select("p_partkey", rsem.isin_or_false("size_gap", [1, 4, 7, 10]).alias("is_member"))


@register("drop_incomplete", with_(PROPS) + """
SELECT * FROM props WHERE tax_total IS NOT NULL AND zoning IS NOT NULL""")
def drop_incomplete_q(spark, sf):
    """drop rows with a missing value in the listed columns."""
    return drop_incomplete(S.properties(spark, sf), ["tax_total", "zoning"])


TEXT_COLS = ["id_text", "big_text", "price_text", "day_text", "status", "gap_text", "late_text"]
_TEXTS = """texts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_text, CAST(o_orderkey * 1000000000 AS VARCHAR) AS big_text, CAST(o_totalprice AS VARCHAR) AS price_text,
         strftime(o_orderdate, '%Y-%m-%d') AS day_text, o_orderstatus AS status, CASE WHEN o_orderkey % 7 = 0 THEN 'NA' ELSE CAST(o_custkey AS VARCHAR) END AS gap_text,
         CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'unknown' ELSE CAST(o_orderkey AS VARCHAR) END AS late_text
  FROM orders)"""


def _type_sql(c: str) -> str:
    gone = f"({c} IS NULL OR {c} IN ('', 'NA'))"
    whole = f"(NOT {gone} AND regexp_full_match({c}, '[+-]?[0-9]+'))"
    held = {"int": f"{whole} AND TRY_CAST({c} AS INTEGER) IS NOT NULL", "bigint": f"{whole} AND TRY_CAST({c} AS BIGINT) IS NOT NULL",
            "double": f"NOT {gone} AND regexp_full_match({c}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')",
            "date": f"NOT {gone} AND regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST({c} AS DATE) IS NOT NULL"}
    counts = ", ".join(f"count(*) FILTER (WHERE {x}) AS n_{k}" for k, x in held.items())
    return f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER (WHERE {gone}) AS n_missing, {counts} FROM texts"


@register("infer_types", with_(_TEXTS) + """, c AS (""" + " UNION ALL ".join(_type_sql(c) for c in TEXT_COLS) + """)
SELECT "column", CASE WHEN n = n_missing THEN 'missing' WHEN n_int = n - n_missing THEN 'int' WHEN n_bigint = n - n_missing THEN 'bigint'
  WHEN n_double = n - n_missing THEN 'double' WHEN n_date = n - n_missing THEN 'date' ELSE 'text' END AS type, n, n_missing, n_int, n_bigint, n_double, n_date FROM c""")
def infer_types(spark, sf):
    """The type of every column of a text table from all its cells, among them one bad cell in the last row."""
    o = S.table(spark, sf, "orders")
    last = o.agg(F.max("o_orderkey")).first()[0]
    key = F.col("o_orderkey")
    texts = o.select(
        key.cast("string").alias("id_text"), (key * 1000000000).cast("string").alias("big_text"), F.col("o_totalprice").cast("string").alias("price_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"), F.col("o_orderstatus").alias("status"),
        F.when(key % 7 == 0, "NA").otherwise(F.col("o_custkey").cast("string")).alias("gap_text"),
        F.when(key == last, "unknown").otherwise(key.cast("string")).alias("late_text"))
    return infer(texts, TEXT_COLS, ["NA"])
