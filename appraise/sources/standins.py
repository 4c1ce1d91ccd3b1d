"""Property and sale tables over the driver's test data (see FIXTURES.md, section C).

``orders`` plays the property table (one row per parcel), ``lineitem`` the sale facts
(many per parcel). The test tables hold no NULLs, so the property stand-in carries gaps
at fixed id patterns, the way the real property file is mostly empty in some columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def gap(col: str, key: str, modulus: int):
    """``col`` with a missing cell wherever ``key % modulus == 0``."""
    return F.when(F.col(key) % F.lit(modulus) == 0, F.lit(None)).otherwise(F.col(col))


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id_parcel, region_zip, tax_total (gaps), zoning (gaps), status, build_year."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id_parcel"),
        F.col("o_custkey").alias("region_zip"),
        gap("o_totalprice", "o_orderkey", 7).alias("tax_total"),
        gap("o_orderpriority", "o_orderkey", 11).alias("zoning"),
        F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").cast("int").alias("build_year"),
    )


def sale_key(li: DataFrame | None = None):
    """Unique text id of a lineitem row (it has no natural key)."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    parts = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), cents]
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def round6(x):
    """Round to 6 decimals as rint(x * 1e6) / 1e6: plain double arithmetic (Spark's decimal-based
    ``round`` is slower); equal to ``round(x, 6)`` except at exact binary ties."""
    return F.rint(x * F.lit(1e6)) / F.lit(1e6)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sale_key, id_parcel, logerror, transactiondate, quantity, price, flag, linestatus, linenumber."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        sale_key().alias("sale_key"),
        F.col("l_orderkey").alias("id_parcel"),
        round6(F.log(F.col("l_extendedprice") / F.lit(25000))).alias("logerror"),
        F.col("l_shipdate").cast("date").alias("transactiondate"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("l_linenumber").alias("linenumber"),
    )


def sales_off_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales``, those of line number 7 under a parcel id (the negative one) that the property table does not list."""
    own = F.when(F.col("linenumber") == 7, -F.col("id_parcel")).otherwise(F.col("id_parcel"))
    return sales(spark, sf_dir).withColumn("id_parcel", own)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey, p_size, size_gap (gaps), size_text ('other' where unparsable), p_brand."""
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey", "p_size", "p_brand", "p_retailprice",
        gap("p_size", "p_partkey", 19).alias("size_gap"),
        F.when(F.col("p_partkey") % 13 == 0, F.lit("other")).otherwise(F.col("p_size").cast("string")).alias("size_text"),
    )


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as located parcels: lat / lon keys and a zip with gaps (lookup fill input)."""
    c = table(spark, sf_dir, "customer")
    zipcode = (F.col("c_custkey") % 50) * 100 + F.col("c_nationkey")
    return c.select(
        "c_custkey",
        (F.col("c_custkey") % 50).alias("lat"),
        F.col("c_nationkey").cast("bigint").alias("lon"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None)).otherwise(zipcode).cast("bigint").alias("zip"),
    )
