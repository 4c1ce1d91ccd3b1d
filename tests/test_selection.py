"""Grouped order statistics, radix selection, co-moments and missing patterns against plain computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from appraise.operators import comoments as M
from appraise.operators import orderstats as O
from appraise.operators import profile as A
from appraise.operators import sampling as R


def grouped(spark, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else (None if i % 7 == 0 else f"g{i % 5}")
        rows.append((i, g, float(rng.integers(0, 6)) if i % 2 else 3.0, float(rng.normal() * 10.0 ** rng.integers(-8, 9)) if i % 11 else None, None if g == "g1" else i * 0.5))
    return rows, spark.createDataFrame(rows, "id long, g string, tied double, wide double, gap double").repartition(6)


@pytest.mark.parametrize("window,accuracy", [(100_000, 10_000), (40, 50), (1, 10)])
def test_grouped_quantiles(spark, window, accuracy):
    rows, df = grouped(spark)
    probs = [0.0, 0.005, 0.25, 0.5, 1.0]
    got = {(r.g, r.column): r for r in O.grouped_quantiles(df, ["tied", "wide", "gap"], probs, ["g"], window_rows=window, accuracy=accuracy).collect()}
    for g in {r[1] for r in rows}:
        for j, c in ((2, "tied"), (3, "wide"), (4, "gap")):
            x = [r[j] for r in rows if r[1] == g and r[j] is not None]
            if not x:
                assert (g, c) not in got
                continue
            assert got[g, c].n == len(x)
            assert np.allclose([got[g, c][f"q{i}"] for i in range(5)], np.quantile(x, probs), rtol=1e-12)


def test_quantiles_without_groups_and_empty(spark):
    rows, df = grouped(spark)
    got = {r.column: r.q0 for r in O.grouped_quantiles(df, ["tied", "wide"], [0.5], window_rows=100).collect()}
    assert got["wide"] == np.quantile([r[3] for r in rows if r[3] is not None], 0.5) and got["tied"] == 3.0
    assert O.grouped_quantiles(df.where("false"), ["tied"], [0.5], ["g"]).collect() == []
    s = {(r.g, r.column): r for r in A.group_summary(df, ["g"], ["tied"]).collect()}
    assert s["hot", "tied"].mean == pytest.approx(np.mean([r[2] for r in rows if r[1] == "hot"])) and (None, "tied") in s


@pytest.mark.parametrize("bits", [0, 3, 9])
def test_splits_by_threshold_equal_ranks(spark, bits, monkeypatch):
    _rows, df = grouped(spark)
    monkeypatch.setattr(R, "bits_for", lambda n: bits)
    for y in ("wide", "g", "tied"):
        fast = {r.id for r in R.split_stratified(df, y, "id", 0.6).where("is_train").collect()}
        ranked = R.split_stratified(df, y, "id", 0.6, keep_helpers=True)
        assert fast == {r.id for r in ranked.where("is_train").collect()}
    monkeypatch.setattr(R, "MAX_STRATA", 2)
    assert fast == {r.id for r in R.split_stratified(df, "tied", "id", 0.6).where("is_train").collect()}
    for share in (0.0, 0.75, 1.0):
        assert R.split_random(df, "id", share).where("is_train").count() == int(share * 3000)
    assert R.split_random(df.where("false"), "id", 0.5).collect() == []


def test_a_split_shuffles_no_rows(spark):
    _rows, df = grouped(spark)
    plan = R.split_random(spark.range(5000), "id", 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    plan = R.split_stratified(spark.range(5000).withColumn("y", F.col("id") % 17.0), "y", "id", 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_all_pairs_of_58_columns_in_one_scan(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 58)) + 1e6 * rng.integers(0, 3, 58)
    x[:, 7] = 2 * x[:, 3] + 5
    x[:, 9] = 4.0
    gone = rng.random((700, 58)) < 0.2
    names = [f"c{i}" for i in range(58)]
    data = [tuple(None if g else float(v) for v, g in zip(r, m)) for r, m in zip(x, gone)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in names)).repartition(5)
    got = {(r.a, r.b): (r.n, r.corr) for r in M.correlations(df, names).collect()}
    assert len(got) == 58 * 57 // 2
    for i in (0, 3, 7, 9, 40):
        for j in range(i + 1, 58):
            both = ~gone[:, i] & ~gone[:, j]
            n, corr = got[names[i], names[j]]
            assert n == both.sum()
            if 9 in (i, j):
                assert corr is None or abs(corr) < 1e-3
            else:
                assert corr == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)
    assert [tuple(r) for r in M.correlations(df.where("false"), names[:2]).collect()] == [("c0", "c1", 0, None)]


def test_missing_patterns_and_classes(spark):
    rows = [(i, None if i % 3 == 0 else 1, None if i % 3 == 0 else "x", None if i % 4 == 0 else 2.0, None) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a int, b string, c double, d int")
    cols = ["id", "a", "b", "c", "d"]
    patterns = M.missing_patterns(df, cols)
    assert {r.pattern: r.n for r in patterns.collect()} == {"00001": 50, "01101": 25, "00011": 16, "01111": 9}
    got = {r.column: (r.n_missing, r.share_missing, r.same_as) for r in M.missingness(patterns, cols).collect()}
    assert got == {"id": (0, 0.0, "id"), "a": (34, 0.34, "a"), "b": (34, 0.34, "a"), "c": (25, 0.25, "c"), "d": (100, 1.0, "d")}
