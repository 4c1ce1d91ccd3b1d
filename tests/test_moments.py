"""Moments of groups: a path of fits and held-out errors from one scan."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from appraise.operators.comoments import group_moments, merge_moments, observed_mean, rows_of_moments
from appraise.operators.sampling import split_random
from appraise.plans import modelling as M
from tests.test_models import sales_like


def gappy(spark):
    return sales_like(spark, 1200).withColumn("tax_total", F.when(F.substring("sale_key", -1, 1) != "4", F.col("tax_total")))


def test_merged_moments_are_those_of_the_filled_rows(spark):
    frame, cols = gappy(spark), ["month", "tax_total", "logerror"]
    parts = [m for _key, m in group_moments(frame, cols, ["fold"], ["tax_total"])]
    fill = observed_mean(parts, 1)
    got = merge_moments(parts, {1: fill})
    x = np.array([[r[c] if r[c] is not None else fill for c in cols] for r in frame.select(*cols).collect()], float)
    assert len(parts) == 6 and got.n == 1200 and np.allclose(got.mean, x.mean(axis=0)) and np.allclose(got.scatter, np.cov(x.T, ddof=0) * 1200)
    few = rows_of_moments(got)
    w, rows = np.array([r[0] for r in few]), np.array([r[1] for r in few])
    assert len(few) == 6 and np.isclose(w.sum(), 1200) and np.allclose(np.average(rows, axis=0, weights=w), got.mean)
    assert np.allclose(np.cov(rows.T, ddof=0, aweights=w), got.scatter / 1200)


def test_a_missing_cell_elsewhere_is_an_error(spark):
    frame = gappy(spark).withColumn("month", F.when(F.col("sale_key") != "k7", F.col("month")))
    with pytest.raises(ValueError, match="1 rows"):
        group_moments(frame, ["month", "tax_total"], ["fold"], ["tax_total"])


def test_the_path_equals_fits_on_the_rows_and_takes_one_scan_for_all(spark, monkeypatch):
    frame, lambdas = gappy(spark), (1e-3, 0.05, 0.3)
    sizes = []
    real = LinearRegression.fit
    monkeypatch.setattr(LinearRegression, "fit", lambda self, d: sizes.append(d.count()) or real(self, d))
    rows, _best, _model, _held = M.lasso_path(frame, lambdas, folds=3)
    monkeypatch.undo()
    assert len(sizes) == 10 and max(sizes[:9]) <= 2 * (len(M.NUMERIC) + 1)  # no fit of the path reads the table
    train = split_random(frame, "sale_key", 0.75).where("is_train")
    for lam, mean, sd in rows:
        each = []
        for f in range(3):
            model = M.pipeline(M.lasso(lam), columns=M.NUMERIC).fit(train.where(F.col("fold") != f))
            each.append(model.transform(train.where(F.col("fold") == f)).agg(F.avg(F.pow(F.col("logerror") - F.col("prediction"), 2))).first()[0])
        assert np.allclose([mean, sd], [np.mean(each), np.std(each, ddof=1)], rtol=1e-4, atol=1e-5), lam  # the fits stop at a tolerance of 1e-6
