"""Profiling, aggregation and top-k queries (inventory 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from appraise.operators import comoments as M
from appraise.operators import profile as A
from appraise.plans.registry import register
from appraise.plans.sqltext import PROPS, SALES, with_
from appraise.sources import standins as S

PROFILE_COLS = ["id_parcel", "region_zip", "tax_total", "zoning", "status", "build_year"]


@register("distinct_values", with_(PROPS) + "SELECT DISTINCT zoning FROM props")
def distinct_values(spark, sf):
    """A2: distinct values (missing included)."""
    return A.distinct_values(S.properties(spark, sf), "zoning")


@register("null_profile", with_(PROPS) + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM props" for c in PROFILE_COLS))
def null_profile(spark, sf):
    """A3: missing count per column (one pass + unpivot)."""
    return A.null_profile(S.properties(spark, sf), PROFILE_COLS)


@register("column_range", with_(PROPS) + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM props"
    for c in ["region_zip", "tax_total", "build_year"]))
def column_range(spark, sf):
    """A4: min and max ignoring missing."""
    return A.column_range(S.properties(spark, sf), ["region_zip", "tax_total", "build_year"])


def _summary_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS q1, "
            f"round(quantile_cont({x}, 0.5), 6) AS median, round(avg({x}), 6) AS mean, "
            f"round(quantile_cont({x}, 0.75), 6) AS q3, round(max({x}), 6) AS max, round(stddev_samp({x}), 6) AS sd, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM props")


@register("column_summary", with_(PROPS) + "\n" + " UNION ALL ".join(_summary_sql(c) for c in ["tax_total", "region_zip"]))
def column_summary(spark, sf):
    """A5: six-number summary, sd and missing count per column."""
    out = A.column_summary(S.properties(spark, sf), ["tax_total", "region_zip"])
    return out.select("column", *[F.round(c, 6).alias(c) for c in ["min", "q1", "median", "mean", "q3", "max", "sd"]],
                      "n_missing")


QPROBS = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]


@register("quantiles", with_(SALES) + "\n" + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(logerror, {p}), 8) AS q FROM sales" for p in QPROBS))
def quantiles(spark, sf):
    """Exact sample quantiles, linear interpolation (type 7)."""
    return A.quantile_table(S.sales(spark, sf), "logerror", QPROBS).select("p", F.round("q", 8).alias("q"))


QUALITY_COLS = ["region_zip", "tax_total", "zoning", "status", "build_year"]


def _quality_sql(c: str, numeric: bool) -> str:
    var = f"var_samp(CAST({c} AS DOUBLE))" if numeric else "CAST(NULL AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
            f"count(DISTINCT {c}) AS n_distinct, round({var}, 0) AS variance, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 8) AS share_missing, "
            f"(count(DISTINCT {c}) <= 1 OR coalesce({var} = 0, false)) AS zero_variance FROM props")


_QUALITY_SQL = " UNION ALL ".join(_quality_sql(c, c in ("region_zip", "tax_total", "build_year")) for c in QUALITY_COLS)


def quality_table(spark, sf):
    return A.column_quality(S.properties(spark, sf), QUALITY_COLS, exact_distinct=True)


@register("column_quality", with_(PROPS) + "\n" + _QUALITY_SQL)
def column_quality(spark, sf):
    """Share missing, distinct count, variance and zero-variance flag per column, one pass."""
    q = quality_table(spark, sf)
    return q.select("column", "n_rows", "n_missing", "n_distinct", F.round("variance", 0).alias("variance"),
                    F.round("share_missing", 8).alias("share_missing"), "zero_variance")


@register("drop_rules", with_(PROPS) + f""",
q AS ({_QUALITY_SQL})
SELECT "column", CASE WHEN share_missing > 0.05 THEN 'missing' WHEN zero_variance THEN 'constant' END AS reason,
       (share_missing > 0.05 OR zero_variance) AS "drop"
FROM q""")
def drop_rules(spark, sf):
    """The drop list from the quality profile (mostly-missing or constant columns)."""
    quality = A.column_quality(S.properties(spark, sf), QUALITY_COLS, exact_distinct=None)
    return A.drop_rules(quality, max_share_missing=0.05).select("column", "reason", "drop")


@register("topk", with_(SALES) + "SELECT sale_key, logerror FROM sales ORDER BY logerror DESC, sale_key LIMIT 20")
def topk(spark, sf):
    """The top 20 rows by a measure (ties by key)."""
    return A.topk(S.sales(spark, sf).select("sale_key", "logerror"), "logerror", 20, ["sale_key"])


PAIR_COLS = ["region_zip", "tax_total", "zoning", "build_year"]


def _pairs_sql() -> str:
    numeric = {"region_zip", "tax_total", "build_year"}
    parts = []
    for i, a in enumerate(PAIR_COLS):
        for b in PAIR_COLS[i + 1:]:
            corr = f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 8)" if a in numeric and b in numeric \
                else "CAST(NULL AS DOUBLE)"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {corr} AS corr, "
                         f"count(*) FILTER (WHERE ({a} IS NULL) <> ({b} IS NULL)) AS missing_mismatch FROM props")
    return " UNION ALL ".join(parts)


@register("column_pairs", with_(PROPS) + "\n" + _pairs_sql())
def column_pairs(spark, sf):
    """Correlated pairs and same-missingness pairs behind the drop lists, one pass."""
    out = A.column_pairs(S.properties(spark, sf), PAIR_COLS)
    return out.select("a", "b", F.round("corr", 8).alias("corr"), "missing_mismatch")


GROUP_COLS = ["quantity", "price", "logerror"]


@register("group_summary", with_(SALES) + "\n" + " UNION ALL ".join(
    f"SELECT flag, '{c}' AS \"column\", count({c}) AS n, " + ", ".join(f"round(quantile_cont({c}, {p}), 6) AS {n}" for p, n in ((0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1, "max")))
    + f", round(avg({c}), 6) AS mean FROM sales GROUP BY flag" for c in GROUP_COLS))
def group_summary(spark, sf):
    """A5, A10: six-number summary of several columns by group, one of which holds half of all rows; all columns and groups are
    narrowed together."""
    out = A.group_summary(S.sales(spark, sf), ["flag"], GROUP_COLS)
    return out.select("flag", "column", "n", *[F.round(c, 6).alias(c) for c in ("min", "q1", "median", "q3", "max", "mean")])


WIDE_COLS = ["region_zip", "tax_total", "build_year", "id_parcel"]


@register("comoment_matrix", with_(PROPS) + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({a}::DOUBLE, {b}::DOUBLE), 8) AS corr FROM props"
    for i, a in enumerate(WIDE_COLS) for b in WIDE_COLS[i + 1:]))
def comoment_matrix(spark, sf):
    """The correlation of every pair of columns from one scan that merges co-moment matrices."""
    return M.correlations(S.properties(spark, sf), WIDE_COLS).withColumn("corr", F.round("corr", 8))


PATTERN_COLS = ["id_parcel", "tax_total", "zoning", "tax_copy", "status", "zoning_copy"]
_COPIES = "SELECT *, tax_total AS tax_copy, zoning AS zoning_copy FROM props"


def _gapped(spark, sf):
    return S.properties(spark, sf).withColumns({"tax_copy": F.col("tax_total"), "zoning_copy": F.col("zoning")})


@register("missing_patterns", with_(PROPS) + "SELECT " + " || ".join(f"({c} IS NULL)::INTEGER::VARCHAR" for c in PATTERN_COLS) + f" AS pattern, count(*) AS n FROM ({_COPIES}) GROUP BY 1")
def missing_patterns(spark, sf):
    """Rows by the pattern of their missing cells."""
    return M.missing_patterns(_gapped(spark, sf), PATTERN_COLS)


@register("missingness_classes", with_(PROPS) + f", c AS ({_COPIES})\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 8) AS share_missing, CASE "
    + " ".join(f"WHEN count(*) FILTER (WHERE ({c} IS NULL) <> ({e} IS NULL)) = 0 THEN '{e}'" for e in PATTERN_COLS[:i + 1]) + " END AS same_as FROM c"
    for i, c in enumerate(PATTERN_COLS)))
def missingness_classes(spark, sf):
    """Share missing and classes of columns that are missing in the same rows, from the pattern table alone."""
    out = M.missingness(M.missing_patterns(_gapped(spark, sf), PATTERN_COLS), PATTERN_COLS)
    return out.withColumn("share_missing", F.round("share_missing", 8))
