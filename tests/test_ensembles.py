"""Boosting that goes on, staged forests, out-of-bag rows."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from appraise.operators import ensembles as N

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 3))
    y = np.where(x[:, 0] > 0.3, 2.0, 0.0) + 0.5 * x[:, 1] + rng.normal(scale=0.3, size=900)
    data = [(i, i % 3, *map(float, x[i]), float(y[i])) for i in range(900)]
    return spark.createDataFrame(data, "id long, fold int, a double, b double, c double, y double").cache(), x, y


def test_a_tree_read_back_predicts_as_mllib(rows):
    df, x, _ = rows
    fit = DecisionTreeRegressor(labelCol="y", maxDepth=6).fit(VectorAssembler(inputCols=NAMES, outputCol="features").transform(df))
    got = fit.transform(VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)).orderBy("id")
    want = np.array([r.prediction for r in got.collect()])
    tree = N.Tree.of(fit)
    assert np.array_equal(tree.predict(x), want)
    assert [r[0] for r in df.orderBy("id").select(tree.column(NAMES)).collect()] == want.tolist()


def test_the_composite_equals_a_plain_fit(rows):
    # MLlib's first tree has weight 1 and later ones step x tree(2 r): with step 0.5 every tree is fitted to r at weight 1
    df, x, _ = rows
    made = N.boost(df, NAMES, "y", "id", rounds=7, step=1.0, base=0.0, depth=2, min_rows=1, block=3)
    vec = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    plain = GBTRegressor(labelCol="y", maxIter=7, maxDepth=2, stepSize=0.5, seed=2016).fit(vec)
    want = [r.prediction for r in plain.transform(vec).orderBy("id").collect()]
    got = [r.prediction for r in made.predict(df).orderBy("id").collect()]
    assert np.allclose(got, want, atol=1e-9)
    assert np.allclose([r[0] for r in made.table.orderBy("id").select("_margin0").collect()], want, atol=1e-9)


def test_blocks_and_going_on_fit_each_round_once(rows, monkeypatch):
    df, _, y = rows
    fits = []
    real = DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, d: fits.append(1) or real(self, d))
    kind = {"step": 0.2, "folds": 3, "row_share": 0.7, "column_share": 0.5}
    whole = N.boost(df, NAMES, "y", "id", rounds=8, block=8, **kind)
    assert len(fits) == 24
    part = N.boost(df, NAMES, "y", "id", rounds=5, block=2, **kind)
    part = N.boost(df, NAMES, "y", "id", rounds=8, block=2, begun=part, **kind)
    assert len(fits) == 48 and np.allclose(whole.curve, part.curve)
    for k in range(3):
        value = np.array([r.prediction for r in whole.predict(df, model=k, rounds=6).orderBy("id").collect()])
        off = np.abs(y - value)
        held = np.arange(900) % 3 == k
        assert np.isclose(whole.curve[5][0][k], off[~held].mean()) and np.isclose(whole.curve[5][1][k], off[held].mean())


def test_cells_give_the_trees_of_the_rows_and_a_round_reads_the_table_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.integers(0, [9, 30, 4], size=(1500, 3)).astype(float)
    y = 0.3 * x[:, 0] + np.where(x[:, 1] > 17, 2.0, 0.0) + rng.normal(scale=0.3, size=1500)
    df = spark.createDataFrame([(i, i % 3, *map(float, x[i]), float(y[i])) for i in range(1500)], "id long, fold int, a double, b double, c double, y double").cache()
    kind = {"rounds": 6, "step": 0.3, "block": 3, "folds": 3, "row_share": 0.7, "column_share": 0.6, "min_rows": 10}
    plain = N.boost(df, NAMES, "y", "id", **kind)
    sizes = []
    real = DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, d: sizes.append(d.count()) or real(self, d))
    cells = N.boost(df, NAMES, "y", "id", cells_over=100, **kind)
    assert len(sizes) == 18 and max(sizes) <= 2 * 9 * 30 and cells.levels is not None and plain.levels is None
    assert np.allclose(plain.curve, cells.curve) and np.allclose(plain.gains, cells.gains)
    for r in (cells.predict(df, model=1).orderBy("id").collect(), cells.table.select("id", F.col("_margin1").alias("prediction")).orderBy("id").collect()):
        assert np.allclose([v.prediction for v in r], [v.prediction for v in plain.predict(df, model=1).orderBy("id").collect()])


def test_levels_of_many_values_are_quantiles_and_missing_cells_an_error(rows, spark):
    df, x, _ = rows
    edges = N.column_levels(df, NAMES)
    assert all(len(e) == 32 for e in edges) and edges[0][-1] == x[:, 0].max()
    many = N.boost(df, NAMES, "y", "id", rounds=4, step=0.5, cells_over=0, depth=2)
    assert many.curve[-1][0][0] < many.curve[0][0][0]
    margin = np.array([r[0] for r in many.table.orderBy("id").select("_margin0").collect()])
    assert np.allclose(margin, [r.prediction for r in many.predict(df).orderBy("id").collect()])
    with pytest.raises(ValueError, match="missing"):
        N.column_levels(spark.createDataFrame([(1.0,), (None,)], "a double"), ["a"])


def test_the_reference_length_ends_by_the_stop(rows):
    df, _, _ = rows
    made = N.boost(df, NAMES, "y", "id", rounds=3000, patience=6, step=0.9, folds=3, block=8)
    test = [np.mean(r[1]) for r in made.curve]
    assert made.rounds < 100 and len(test) - 1 - int(np.argmin(test)) >= 6


def test_stages_equal_the_first_trees(rows):
    df, x, y = rows
    vec = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    model = RandomForestRegressor(labelCol="y", numTrees=12, maxDepth=7, seed=3).fit(vec)
    got = {r.num_trees: (r.n, r.mae, r.mse) for r in N.staged_errors(model, df, NAMES, "y", [12, 1, 5]).collect()}
    each = np.array([N.Tree.of(t).predict(x) for t in model.trees])
    for count in (1, 5, 12):
        off = each[:count].mean(axis=0) - y
        assert got[count][0] == 900 and np.allclose(got[count][1:], [np.abs(off).mean(), (off ** 2).mean()])
    whole = model.transform(vec).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert np.isclose(got[12][1], whole)


def test_bags_are_poisson_and_out_of_bag_finds_the_planted_feature(rows, spark):
    df, x, y = rows
    weights = np.array([[r[f"w{t}"] for t in range(10)] for r in df.orderBy("id").select(*[N.bag_weight(t, "id").alias(f"w{t}") for t in range(10)]).collect()])
    for t in (0, 6, 7):
        h = hashlib.md5(f"bag:{t // 7}:5".encode()).hexdigest()
        assert weights[5, t] == sum(int(h[4 * (t % 7):4 * (t % 7) + 4], 16) >= c for c in N._POISSON)
    assert abs(weights.mean() - 1) < 0.05 and abs((weights == 0).mean() - np.exp(-1)) < 0.03
    trees = N.bagged_forest(df, NAMES, "y", "id", trees=10, mtry=2, depth=5)
    errors, importance = N.out_of_bag(df, trees, NAMES, "y", "id")
    each, out = np.array([t.predict(x) for t in trees]).T, weights == 0
    some = out.any(axis=1)
    off = (each * out)[some].sum(axis=1) / out[some].sum(axis=1) - y[some]
    assert errors["n_oob"] == some.sum() and np.isclose(errors["mae"], np.abs(off).mean()) and np.isclose(errors["mse"], (off ** 2).mean())
    assert [r[0] for r in importance][0] == "a" and importance[0][1] > 10 * abs(importance[-1][1])
    assert importance[0][2] > 5
