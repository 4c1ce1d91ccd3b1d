"""SQL text for the DuckDB oracles: the stand-in tables and the keyed hash, written once."""

from __future__ import annotations


def h(salt: str, expr: str) -> str:
    """DuckDB form of ``appraise.functions.hashing.keyed_hash`` for a literal salt."""
    return f"CAST(('0x' || substr(md5('{salt}:' || CAST({expr} AS VARCHAR)), 1, 15)) AS BIGINT)"


def h_dyn(salt_expr: str, expr: str) -> str:
    """Keyed hash with a salt given as a SQL text expression."""
    return f"CAST(('0x' || substr(md5({salt_expr} || ':' || CAST({expr} AS VARCHAR)), 1, 15)) AS BIGINT)"


PROPS = """props AS (
  SELECT o_orderkey AS id_parcel, o_custkey AS region_zip,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS tax_total,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS zoning,
         o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS build_year
  FROM orders)"""

SALES = """sales AS (
  SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS sale_key,
         l_orderkey AS id_parcel, round(ln(l_extendedprice / 25000), 6) AS logerror,
         CAST(l_shipdate AS DATE) AS transactiondate, l_quantity AS quantity, l_extendedprice AS price,
         l_returnflag AS flag, l_linestatus AS linestatus, l_linenumber AS linenumber
  FROM lineitem)"""

OFF_LIST = """off_list AS (
  SELECT * REPLACE (CASE WHEN linenumber = 7 THEN -id_parcel ELSE id_parcel END AS id_parcel) FROM sales)"""

PARTS = """parts AS (
  SELECT p_partkey, p_size, p_brand, p_retailprice,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_size END AS size_gap,
         CASE WHEN p_partkey % 13 = 0 THEN 'other' ELSE CAST(p_size AS VARCHAR) END AS size_text
  FROM part)"""

LOCATED = """located AS (
  SELECT c_custkey, c_custkey % 50 AS lat, CAST(c_nationkey AS BIGINT) AS lon,
         CAST(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey % 50) * 100 + c_nationkey END AS BIGINT) AS zip
  FROM customer)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def strata_cte(src: str, y: str, idc: str, salt: str, name: str = "ranked") -> str:
    """Quartile strata of ``y`` and the rank in h(salt, id) order inside each stratum."""
    return f"""_q_{name} AS (
  SELECT quantile_cont({y}, 0.25) AS c1, quantile_cont({y}, 0.5) AS c2, quantile_cont({y}, 0.75) AS c3 FROM {src}),
_s_{name} AS (
  SELECT t.*, CASE WHEN {y} IS NULL THEN NULL ELSE
           CAST((CASE WHEN {y} > c1 THEN 1 ELSE 0 END) + (CASE WHEN {y} > c2 THEN 1 ELSE 0 END)
              + (CASE WHEN {y} > c3 THEN 1 ELSE 0 END) AS INTEGER) END AS stratum,
         {h(salt, idc)} AS hh
  FROM {src} t, _q_{name}),
{name} AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY hh, {idc}) - 1 AS rnk,
         count(*) OVER (PARTITION BY stratum) AS n_s
  FROM _s_{name})"""
