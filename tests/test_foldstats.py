"""Statistics with a fold left out equal the statistic of the other folds' rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from appraise.operators import foldstats as L
from appraise.operators import scale as Z


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    data = [(i, int(i % 4), float(np.exp(rng.normal(3, 0.7))) if i % 5 else None, float(1e9 + rng.normal()), f"l{min(i, 40)}" if i % 3 else None) for i in range(400)]
    return spark.createDataFrame(data, "id long, fold int, x double, far double, level string").cache()


def test_moments(rows):
    for f, c, n, mean, sd in L.excluded_moments(rows, ["x", "far"]):
        want = rows.where(F.col("fold") != f).agg(F.count(c), F.avg(c), F.stddev_samp(c)).first()
        assert n == want[0] and np.isclose(mean, want[1], rtol=1e-12) and np.isclose(sd, want[2], rtol=1e-6)


def test_boxcox_profile(rows):
    got = {}
    for f, lam, v in L.excluded_boxcox(rows, "x"):
        got.setdefault(f, {})[lam] = v
    for f in range(4):
        want = {r["lambda"]: r.loglik for r in Z.boxcox_profile(rows.where(F.col("fold") != f), "x").collect()}
        assert all(np.isclose(got[f][lam], v, rtol=1e-8) for lam, v in want.items())


def test_levels_and_fill(rows):
    got = {}
    for r in L.excluded_levels(rows, "level").collect():
        got.setdefault(r.fold, set()).add(r.level)
    for f in range(4):
        assert got[f] == {r.level for r in rows.where((F.col("fold") != f) & F.col("level").isNotNull()).select("level").distinct().collect()}
    filled = L.excluded_fill(rows, ["x"]).where("id % 5 = 0").groupBy("fold").agg(F.min("x").alias("a"), F.max("x").alias("b")).collect()
    for r in filled:
        want = rows.where(F.col("fold") != r.fold).agg(F.avg("x")).first()[0]
        assert np.isclose(r.a, want) and r.a == r.b


def test_empty_and_single_fold(rows):
    assert L.excluded_moments(rows.where("false"), ["x"]) == [] and L.excluded_boxcox(rows.where("false"), "x") == []
    assert L.excluded_levels(rows.where("false"), "level").collect() == []
    assert L.excluded_moments(rows.where("fold = 0"), ["x"]) == [(0, "x", 0, None, None)]
    assert L.excluded_fill(rows.where("fold = 0"), ["x"]).where("x is null").count() == 20
