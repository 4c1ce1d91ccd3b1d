"""Edge cases of metrics, fills, codes and quantiles that the tables of the oracle tests do not hold."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from appraise.functions.hashing import HASH_SPACE, keyed_hash, keyed_uniform
from appraise.operators import encode, evaluate, impute, profile, quantiles
from appraise.plans import cleaning


def test_hash_draws_reach_slots_past_32_bits(spark):
    n = 10 ** 11
    got = [r[0] for r in spark.range(2000).select((keyed_hash("s", "id") % F.lit(n)).alias("p")).collect()]
    assert 0 <= min(got) and max(got) < n and np.mean([g >= 1 << 32 for g in got]) > 0.9 and HASH_SPACE == 1 << 60
    u = [r[0] for r in spark.range(2000).select(keyed_uniform("s", "id")).collect()]
    assert 0 < min(u) and max(u) < 1 and abs(np.mean(u) - 0.5) < 0.03


class Counted:
    """Counts the aggregate passes over a DataFrame's values."""

    def __init__(self, df):
        self.df, self.passes = df, 0

    def agg(self, *a):
        self.passes += 1
        return self.df.agg(*a)

    def where(self, c):
        self.passes += 1
        return self.df.where(c)


@pytest.mark.parametrize("kinds", [1, 2, 4, 7])
def test_quantiles_of_tied_values_end_in_a_few_passes(spark, kinds):
    n = 400_000
    values = spark.range(n).select((F.col("id") % kinds).cast("double").alias("_v"))
    want = np.sort(np.arange(n) % kinds)
    ranks = [0, n // 4, n // 2 - 1, n // 2, 3 * n // 4, n - 1]
    seen = Counted(values)
    got = quantiles.exact_order_stats(seen, ranks, n, window_rows=1000)
    assert got == {r: float(want[r]) for r in ranks} and seen.passes <= 4


def test_quantiles_of_mixed_columns(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=3000), np.zeros(2500), np.ones(2500), rng.integers(0, 5, 2000)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    probs = [0.0, 0.005, 0.25, 0.3, 0.5, 0.75, 0.995, 1.0]
    got = quantiles.exact_quantiles(df, "v", probs, window_rows=50, accuracy=50)
    assert np.allclose(got, np.quantile(x, probs), rtol=0, atol=1e-12)


def test_constant_predictions_keep_their_other_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (5.0, 2.0)], "obs double, pred double")
    r = evaluate.error_metrics(df).first()
    assert r["corr"] is None and r["mae"] == pytest.approx(5 / 3) and r["n"] == 3
    assert {p.corr for p in profile.column_pairs(df, ["obs", "pred"]).collect()} == {None}


def test_argmin_skips_missing_metrics(spark):
    t = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.2), (4, float("nan"))], "k int, m double")
    assert evaluate.argmin_row(t, "m", ["k"]).first()["k"] == 3


def test_accuracy_uses_one_population(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, None)], "obs int, pred int")
    r = evaluate.accuracy_kappa(df).first()
    assert (r["n"], r["accuracy"]) == (2, 0.5)


def test_mean_of_an_integer_column_is_not_cut(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "id int, x int")
    assert {r.id: r.x for r in impute.impute_mean(df, ["x"]).collect()} == {1: 2.0, 2: 3.0, 3: 2.5}


def test_missing_is_a_level_apart_from_the_text_na(spark):
    df = spark.createDataFrame([(1, "NA"), (2, None)], "id int, x string")
    assert {r.x for r in impute.na_category(df, ["x"]).collect()} == {"NA", "__NA__"}


def test_unseen_levels_have_no_code(spark):
    from pyspark.ml.feature import StringIndexer
    seen = spark.createDataFrame([("a",), ("b",)], "_level string")
    model = StringIndexer(inputCol="_level", outputCol="_code", stringOrderType="alphabetAsc", handleInvalid="keep").fit(seen)
    df = spark.createDataFrame([("b",), ("z",), (None,)], "x string")
    assert [r.c for r in encode.level_codes(df, "x", "c", model=model).collect()] == [2, None, None]


def test_many_column_donors_keep_every_type_exactly(spark):
    day, big = datetime.date(2016, 5, 1), 9007199254740993
    rows = [(1, big, "it", day, 0.1), (2, None, None, None, None), (3, None, "it", None, 0.1)]
    df = spark.createDataFrame(rows, "id int, n long, t string, d date, x double")
    specs = {c: (None, True) for c in ("n", "t", "d", "x")}
    got = {tuple(r)[1:] for r in impute.hot_deck_many(df, specs, "id").collect()}
    assert got == {(big, "it", day, 0.1)}


def test_first_round_keeps_the_zip_and_drops_the_city():
    assert "region_zip" not in cleaning.ROUND_ONE_DROP and "region_city" in cleaning.ROUND_ONE_DROP
    assert "region_zip" in cleaning.ROUND_ONE_DONORS


def test_side_by_side_scoring_has_no_shuffle_and_rounds_half_to_even(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from appraise.operators.score import SUBMISSION_MONTHS, score_months
    train = spark.createDataFrame([(float(m), m / 8.0) for m in range(1, 25)], "month double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["month"], outputCol="features"), LinearRegression(labelCol="y")]).fit(train)
    wide = score_months(model, spark.range(50).withColumnRenamed("id", "parcel"), "parcel", SUBMISSION_MONTHS, digits=1)
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    assert wide.count() == 50 and wide.columns == ["parcel", *[label for _, label in SUBMISSION_MONTHS]]
