"""Model jobs: closed-form checks, planted signals, and smoke runs of the registered keys."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

import __spark_entry__ as E
from appraise.operators.sampling import split_random
from appraise.operators.score import SUBMISSION_MONTHS, score_months
from appraise.plans import modelling as M
from appraise.plans.cleaning import FEATURES
from tests.conftest import SF_SMALL


def planted(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 2.0 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.1, size=n)
    rows = [(i, int(i % 3), *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, y double"), x, y


def sales_like(spark, n=2000, seed=3):
    """Rows with the training frame's columns: uncentred inputs, a target that depends on two of them."""
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(1, 13, n), rng.normal(200, 30, n), rng.integers(1, 6, n), rng.integers(1, 4, n), rng.normal(1995, 3, n),
                  rng.integers(90000, 90100, n)], axis=1).astype(float)
    y = 0.02 * (x[:, 1] - 200) + 0.3 * (x[:, 3] - 2) + rng.normal(0, 0.2, n)
    rows = [(f"k{i}", i % 3, *map(float, x[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "sale_key string, fold int, " + ", ".join(f"{c} double" for c in FEATURES) + ", logerror double")


def test_lasso_is_mllib_on_uncentred_columns_and_scores_the_holdout(spark):
    frame = sales_like(spark)
    path, best, model, held = M.lasso_path(frame, (1e-4, 0.1, 100.0), folds=3)
    assert [r[0] for r in path] == [1e-4, 0.1, 100.0] and best == min(path, key=lambda r: r[1])[0] < 100 and held.count() == 500
    train = split_random(frame, "sale_key", 0.75).where("is_train")
    own = M.pipeline(M.lasso(best), columns=M.NUMERIC).fit(train).stages[-1].coefficients.toArray()
    assert np.allclose(model.stages[-1].coefficients.toArray(), own)
    x = np.array([[r[c] for c in M.NUMERIC] for r in train.where("fold <> 1").collect()])
    y = np.array([r.logerror for r in train.where("fold <> 1").collect()])
    free = np.linalg.lstsq(x, y, rcond=None)[0]  # no penalty: plain least squares without an intercept
    assert np.allclose(M.pipeline(M.lasso(0.0), columns=M.NUMERIC).fit(train.where("fold <> 1")).stages[-1].coefficients.toArray(), free, atol=1e-6)


def test_sign_models_report_the_holdout_table(spark):
    from pyspark.ml.tuning import ParamGridBuilder
    clf = M.sign_forest(10, 4)
    grid = ParamGridBuilder().addGrid(clf.featureSubsetStrategy, ["2", "4"]).build()
    cvm, held = M.sign_cv(sales_like(spark), clf, grid)
    rows = M._sign_table(spark, cvm, grid, {"featureSubsetStrategy": "mtry"}, held).collect()
    won = [r for r in rows if r.best]
    assert len(rows) == 2 and len(won) == 1 and won[0].holdout_accuracy > 0.8
    assert won[0].obs0_pred0 + won[0].obs0_pred1 + won[0].obs1_pred0 + won[0].obs1_pred1 == held.count()


def test_boosting_stops_early_and_finds_more_rounds_when_needed(spark):
    frame = sales_like(spark, 600)
    rows, best = M.boost_curves(frame, rounds=64, patience=3, step=0.5, block=4)
    assert best == min(rows, key=lambda r: r[3])[0] and (len(rows) == best + 3 or len(rows) == 64) and len(rows) > 4


def test_search_covers_all_seven_axes(spark):
    axes = {k: v[:1] for k, v in M.SEARCH.items()} | {"maxIter": (3,), "maxDepth": (2, 3)}
    cvm, grid = M.boosting_search(sales_like(spark, 300), axes)
    assert len(axes) == 7 and len(cvm.avgMetrics) == len(grid) == 2


def test_forest_beats_median_and_finds_planted_feature(spark):
    df, _, y = planted(spark)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"),
                             RandomForestRegressor(labelCol="y", numTrees=20, maxDepth=6, seed=1)]).fit(df)
    pred = model.transform(df)
    mae = pred.agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert mae < np.mean(np.abs(y - np.median(y)))
    imp = model.stages[-1].featureImportances.toArray()
    assert int(np.argmax(imp)) == 0


def test_score_months_is_wide(spark):
    df, _, _ = planted(spark, n=50)
    df = df.withColumn("month", F.lit(10))
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "month"], outputCol="features"),
                             LinearRegression(labelCol="y")]).fit(df)
    wide = score_months(model, df.drop("month"), "id", SUBMISSION_MONTHS, "month")
    assert wide.columns == ["id"] + [lbl for _, lbl in SUBMISSION_MONTHS]
    assert wide.count() == 50


@pytest.mark.parametrize("key", ["rf_cv", "rf_tree_sweep", "rf_oob", "importance_permutation", "importance_gain", "predict_pivot", "gbt_sign", "rf_sign_cv", "gbt_search"])
def test_model_queries_run(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    assert df.count() > 0


def test_depth_one_tree_is_the_best_single_split(spark):
    from pyspark.ml.regression import DecisionTreeRegressor
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, size=400).astype(float)
    y = np.where(x > 12, 3.0, 0.0) + rng.normal(scale=0.5, size=400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    feats = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    tree = DecisionTreeRegressor(labelCol="y", maxDepth=1, maxBins=64).fit(feats)
    got = np.array([r.prediction for r in tree.transform(feats).select("prediction").collect()])
    best, best_sse = None, np.inf
    for t in np.unique(x)[:-1]:
        left, right = y[x <= t], y[x > t]
        sse = ((left - left.mean()) ** 2).sum() + ((right - right.mean()) ** 2).sum()
        if sse < best_sse:
            best, best_sse = t, sse
    want = np.where(x <= best, y[x <= best].mean(), y[x > best].mean())
    assert np.allclose(got, want)


def test_boxcox_stage_fits_on_training_rows_and_persists(spark, tmp_path):
    from appraise.operators.scale import boxcox_apply, boxcox_lambda
    from appraise.operators.stages import BoxCox, BoxCoxModel
    from appraise.sources import standins as S
    s = S.sales(spark, "/root/testdata/sf0.001").select("sale_key", "price")
    model = BoxCox(inputCol="price", outputCol="price_bc").fit(s)
    assert model.getOrDefault(model.lam) == boxcox_lambda(s, "price")
    got = {r[0]: r[1] for r in model.transform(s).select("sale_key", "price_bc").collect()}
    want = {r[0]: r[1] for r in boxcox_apply(s, "price", out_col="price_bc").select("sale_key", "price_bc").collect()}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    train = s.where(F.col("price") < 30000)
    sub = BoxCox(inputCol="price", outputCol="price_bc").fit(train)
    assert sub.getOrDefault(sub.mean) != model.getOrDefault(model.mean)
    path = str(tmp_path / "bc")
    model.write().overwrite().save(path)
    again = BoxCoxModel.load(path)
    assert again.getOrDefault(again.lam) == model.getOrDefault(model.lam)
    inside = Pipeline(stages=[BoxCox(inputCol="price", outputCol="z"),
                              VectorAssembler(inputCols=["z"], outputCol="features")]).fit(s)
    assert inside.transform(s).count() == s.count()


def test_out_of_fold_rows_stack_and_leader(spark):
    frame = sales_like(spark, 600)
    models = {"linear": M.families()["linear"], "forest": (M.forest(8, 5, 3), {})}
    oof = M.out_of_fold(frame, models)
    assert oof.count() == 600 == oof.select("sale_key").distinct().count()
    own = M.pipeline(M.forest(8, 5, 3)).fit(frame.where("fold <> 1")).transform(frame.where("fold = 1"))
    pairs = own.select("sale_key", "prediction").join(oof.select("sale_key", "forest"), "sale_key").collect()
    assert len(pairs) == 200 and all(r.prediction == r.forest for r in pairs)
    weights = M.stack_weights(oof, ["linear", "forest"])
    rows = oof.collect()
    x, y = np.array([[r.linear, r.forest] for r in rows]), np.array([r.logerror for r in rows])
    best = ((y - x @ np.array(list(weights.values()))) ** 2).sum()
    grid = np.linspace(0, 1.5, 31)
    assert all(w >= 0 for w in weights.values()) and best <= min(((y - a * x[:, 0] - b * x[:, 1]) ** 2).sum() for a in grid for b in grid) + 1e-9
    ranked, _ = M.search(frame, models)
    assert [r[0] for r in ranked][0] in ("stack", "forest", "linear") and ranked == sorted(ranked, key=lambda r: r[1]) and len(ranked) == 3
    both = M.Weighted({n: M.pipeline(e, **k).fit(frame) for n, (e, k) in models.items()}, {"linear": 0.5, "forest": 2.0})
    got = both.transform(frame.where("fold = 0"))
    one = M.pipeline(models["forest"][0]).fit(frame).transform(frame.where("fold = 0")).orderBy("sale_key").first().prediction
    two = M.pipeline(models["linear"][0], **models["linear"][1]).fit(frame).transform(frame.where("fold = 0")).orderBy("sale_key").first().prediction
    assert got.columns == [*frame.columns, "prediction"] and np.isclose(got.orderBy("sale_key").first().prediction, 0.5 * two + 2 * one)
