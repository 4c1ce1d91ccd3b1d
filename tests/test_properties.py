"""Properties of the distributed operators against brute force on small inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from appraise.functions.hashing import keyed_hash
from appraise.operators import impute as I
from appraise.operators import sampling as R
from appraise.operators import scale as Z
from appraise.operators.quantiles import exact_quantiles
from appraise.operators.ranking import hash_rank
from appraise.sources import standins as S
from tests.conftest import SF_SMALL


def type7(values, p):
    return float(np.quantile(np.array(values, dtype=float), p, method="linear"))


@pytest.mark.parametrize("window_rows", [1_000_000, 50])
def test_exact_quantiles_match_type7_with_hot_value(spark, window_rows):
    rnd = random.Random(7)
    vals = [rnd.gauss(0, 1) for _ in range(3000)] + [0.25] * 1500 + [None] * 10  # a value holding a third of the rows
    df = spark.createDataFrame([(v,) for v in vals], "y double")
    probs = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]
    got = exact_quantiles(df, "y", probs, window_rows=window_rows, accuracy=100)
    clean = [v for v in vals if v is not None]
    for p, g in zip(probs, got):
        assert g == pytest.approx(type7(clean, p), abs=1e-12)


def test_hash_rank_equals_global_row_number(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") % 3).cast("int")).withColumn("h", keyed_hash("t", "id"))
    got = hash_rank(df, "h", "id", partition_cols=["g"], bits=4, count_col="n")
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")) - 1)
    joined = got.join(want.select("id", "want"), "id")
    assert joined.where(F.col("_rank") != F.col("want")).count() == 0
    assert joined.count() == 5000
    assert {r["g"]: r["n"] for r in got.select("g", "n").distinct().collect()} == {0: 1667, 1: 1667, 2: 1666}


def test_hash_rank_keeps_null_group(spark):
    df = spark.createDataFrame([(i, None if i < 3 else 1) for i in range(10)], "id long, g int")
    out = hash_rank(df.withColumn("h", keyed_hash("x", "id")), "h", "id", partition_cols=["g"], count_col="n")
    assert out.count() == 10
    assert sorted(r["_rank"] for r in out.where(F.col("g").isNull()).collect()) == [0, 1, 2]


def test_split_is_a_partition_and_stratified(spark):
    s = S.sales(spark, SF_SMALL).select("sale_key", "logerror")
    out = R.split_stratified(s, "logerror", "sale_key", 0.6, keep_helpers=True).cache()
    n = s.count()
    assert out.count() == n and out.select("sale_key").distinct().count() == n
    for r in out.groupBy("_stratum").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_train").cast("int")).alias("t")).collect():
        assert r["t"] == math.ceil(0.6 * r["n"])


def test_same_rows_on_any_partitioning(spark):
    s = S.sales(spark, SF_SMALL).select("sale_key", "logerror")
    a = R.stratified_folds(s, "logerror", "sale_key", 3)
    b = R.stratified_folds(s.repartition(13), "logerror", "sale_key", 3)
    assert sorted(a.collect()) == sorted(b.collect())


def test_folds_cover_each_row_once_and_balance(spark):
    s = S.sales(spark, SF_SMALL).select("sale_key", "logerror")
    f = R.stratified_folds(s, "logerror", "sale_key", 3)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sum(sizes) == s.count() and sizes[-1] - sizes[0] <= 4


def test_random_split_exact_size(spark):
    p = S.properties(spark, SF_SMALL).select("id_parcel")
    out = R.split_random(p, "id_parcel", 0.75)
    n = p.count()
    assert out.where("is_train").count() == math.floor(0.75 * n)


@pytest.mark.parametrize("resamples", [3, 7])
def test_bootstrap_columns_are_the_weights_of_each_resample(spark, resamples):
    ids = spark.createDataFrame([(f"k{i % 350}",) for i in range(400)], "id string")
    wide = {r.id: tuple(r)[1:] for r in R.bootstrap_columns(ids, "id", resamples).collect()}
    long = {}
    for r in R.bootstrap_weights(ids, "id", resamples).collect():
        long.setdefault(r.id, [0] * resamples)[r.resample] += r.weight
    assert wide == {k: tuple(v) for k, v in long.items()} and sum(map(sum, wide.values())) == 400 * resamples


def test_bootstrap_rows_are_shuffled_once_for_all_resamples(spark):
    plan = R.bootstrap_columns(spark.range(5000), "id", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan


def test_bootstrap_weights_are_n_draws(spark):
    p = S.properties(spark, SF_SMALL).select("id_parcel")
    n = p.count()
    w = R.bootstrap_weights(p, "id_parcel", 3)
    sums = {r["resample"]: r["s"] for r in w.groupBy("resample").agg(F.sum("weight").alias("s")).collect()}
    assert sums == {0: n, 1: n, 2: n}
    oob = w.where("weight = 0").groupBy("resample").count().collect()
    for r in oob:  # about e^-1 of the rows are out of bag
        assert abs(r["count"] / n - math.exp(-1)) < 0.05


def test_shuffle_is_a_permutation(spark):
    p = S.properties(spark, SF_SMALL).select("id_parcel", "tax_total")
    sh = R.shuffle_column(p, "tax_total", "id_parcel")
    before = sorted((r[0] is None, r[0] or 0) for r in p.select("tax_total").collect())
    after = sorted((r[0] is None, r[0] or 0) for r in sh.select("tax_total").collect())
    assert before == after and sh.count() == p.count()


def test_hot_deck_values_come_from_donors(spark):
    p = S.properties(spark, SF_SMALL).select("id_parcel", "tax_total")
    out = I.hot_deck(p, "tax_total", "id_parcel")
    donors = {r[0] for r in p.where(F.col("tax_total").isNotNull()).select("tax_total").collect()}
    assert out.where(F.col("tax_total").isNull()).count() == 0
    assert {r[0] for r in out.select("tax_total").collect()} <= donors
    assert out.count() == p.count()


def test_restricted_hot_deck_without_replacement(spark):
    parts = S.parts(spark, SF_SMALL).select("p_partkey", "size_gap")
    rep = {}
    out = I.hot_deck(parts, "size_gap", "p_partkey", salt="r", replace=False, out_col="filled",
                     donor_filter=F.col("size_gap").isin(1, 4, 7, 10), report=rep)
    filled = out.where(F.col("size_gap").isNull()).select("filled").collect()
    assert all(r[0] in (1, 4, 7, 10) for r in filled)
    assert rep["reused"] == max(0, rep["gaps"] - rep["donors"])


def test_hot_deck_reuses_when_gaps_outnumber_donors(spark):
    df = spark.createDataFrame([(i, 5.0 if i < 3 else None) for i in range(20)], "id long, x double")
    rep = {}
    out = I.hot_deck(df, "x", "id", replace=False, report=rep)
    assert out.where(F.col("x").isNull()).count() == 0
    assert rep == {"donors": 3, "gaps": 17, "reused": 14, "unfilled": 0}


def test_zscore_mean_zero_sd_one(spark):
    p = S.properties(spark, SF_SMALL).select("id_parcel", "tax_total")
    z = Z.zscore(p, ["tax_total"]).agg(F.avg("tax_total").alias("m"), F.stddev_samp("tax_total").alias("s")).first()
    assert abs(z["m"]) < 1e-9 and abs(z["s"] - 1) < 1e-9


def test_boxcox_lambda_matches_brute_force(spark):
    x = np.array([r[0] for r in S.sales(spark, SF_SMALL).select("price").collect()])
    best, best_ll = None, -np.inf
    for lam in Z.BOXCOX_GRID:
        t = np.log(x) if lam == 0 else (x ** lam - 1) / lam
        ll = -len(x) / 2 * np.log(t.var()) + (lam - 1) * np.log(x).sum()
        if ll > best_ll:
            best, best_ll = lam, ll
    got = Z.boxcox_lambda(S.sales(spark, SF_SMALL), "price", fudge=0.0)
    assert got == pytest.approx(best)


def test_lookup_fill_only_fills_missing(spark):
    df = spark.createDataFrame([(1, 10, 20, None), (2, 10, 20, 7), (3, 11, 21, None)], "id long, a int, b int, z int")
    lk = spark.createDataFrame([(10, 20, 99)], "a int, b int, z int")
    out = {r["id"]: r["z"] for r in I.fill_lookup(df, lk, ["a", "b"], "z", "z").collect()}
    assert out == {1: 99, 2: 7, 3: None}


def test_skew_join_equals_plain_join_with_a_hot_key(spark):
    from appraise.operators.joins import hot_keys, skew_join
    facts = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("k"),
                                     F.col("id").alias("v"))
    props = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("attr"))
    assert hot_keys(facts, "k", 0.01) == [7]
    for how in ("inner", "left"):
        a = sorted(skew_join(facts, props, "k", how, buckets=8).collect())
        b = sorted(facts.join(props, "k", how).collect())
        assert a == b


def test_broadcast_small_respects_bound(spark):
    from appraise.operators.joins import broadcast_small
    df = spark.range(50)
    assert broadcast_small(df, 100).count() == 50
    assert broadcast_small(df, 10) is df


def test_hash_rank_bits_follow_rows():
    from appraise.operators.ranking import bits_for
    assert bits_for(1000) == 0 and bits_for(10**6) == 6 and bits_for(10**12) == 20


def test_class_strata_for_a_categorical_outcome(spark):
    s = S.sales(spark, SF_SMALL).select("sale_key", "flag")
    out = R.split_stratified(s, "flag", "sale_key", 0.75, keep_helpers=True)
    for r in out.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_train").cast("int")).alias("t")).collect():
        assert r["t"] == math.ceil(0.75 * r["n"])


def test_scaler_inside_cv_uses_training_rows_only(spark):
    from pyspark.ml.regression import LinearRegression
    from appraise.plans.modelling import pipeline
    df = spark.createDataFrame([(float(i), float(i % 7), 2.0 * i) for i in range(60)],
                               "month double, tax_total double, logerror double")
    df = df.withColumns({c: F.lit(1.0) for c in ["zoning_code", "status_code", "build_year", "region_zip"]})
    model = pipeline(LinearRegression(labelCol="logerror"), scale=True).fit(df.where("month < 30"))
    mean = model.stages[-2].mean.toArray()[0]
    assert mean == pytest.approx(14.5)


def test_hot_deck_many_equals_single_column_draws(spark):
    rows = []
    for i in range(400):
        rows.append((i, None if i % 5 == 0 else float(i % 9), None if i % 7 == 0 else int(i % 13),
                     None if i % 3 == 0 else float(i % 4)))
    df = spark.createDataFrame(rows, "id long, a double, b int, c double")
    specs = {"a": (None, True), "b": ((1, 4, 7, 10), False), "c": ((1, 2), True)}
    many = {r["id"]: r for r in I.hot_deck_many(df, specs, "id", salt="m").collect()}
    assert len(many) == 400
    for col, (allowed, replace) in specs.items():
        pred = None if allowed is None else F.col(col).isin(*allowed)
        one = {r["id"]: r[col] for r in I.hot_deck(df, col, "id", salt=f"m:{col}", donor_filter=pred,
                                                    replace=replace).collect()}
        assert {k: many[k][col] for k in one} == one
    assert isinstance(many[0]["b"], int)


@pytest.mark.parametrize("key", ["impute_hotdeck", "impute_hotdeck_restricted", "impute_hotdeck_multi", "split_stratified",
                                 "split_random", "bootstrap_weights", "shuffle_column", "random_category"])
def test_random_steps_repeat_under_other_partition_counts(spark, key):
    import __spark_entry__ as E
    q = E.queries()[key]
    runs = []
    for parts in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        runs.append(sorted(map(tuple, q(spark, SF_SMALL).collect()), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert runs[0] == runs[1]


@pytest.mark.parametrize("window_rows", [2, 1000])
def test_exact_quantiles_nan_sorts_last_like_spark(spark, window_rows):
    vals = [1.0, 2.0, float("nan"), 3.0, None, 4.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "y double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, "y", probs, window_rows=window_rows, accuracy=10)
    want = df.agg(F.percentile("y", probs)).first()[0]
    assert [str(x) for x in got] == [str(x) for x in want]
