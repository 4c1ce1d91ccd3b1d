"""Generated inputs for the core distributed operators, against brute force."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from appraise.functions.hashing import keyed_hash
from appraise.functions.numeric import fixed_mean
from appraise.operators.quantiles import exact_quantiles
from appraise.operators.ranking import hash_rank

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
values = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                  min_size=1, max_size=300)


@SETTINGS
@given(vals=values, probs=st.lists(st.floats(0, 1), min_size=1, max_size=5), window=st.sampled_from([3, 20, 10_000]))
def test_exact_quantiles_any_input(spark, vals, probs, window):
    df = spark.createDataFrame([(v,) for v in vals], "y double")
    got = exact_quantiles(df, "y", probs, window_rows=window, accuracy=50)
    clean = np.array([v for v in vals if v is not None], dtype=float)
    for p, g in zip(probs, got):
        if len(clean) == 0:
            assert g is None
        else:
            assert g == np.quantile(clean, p, method="linear") or abs(g - np.quantile(clean, p, method="linear")) <= 1e-9 * max(1.0, abs(g))


@SETTINGS
@given(groups=st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=400),
       bits=st.integers(0, 6))
def test_hash_rank_any_grouping(spark, groups, bits):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "id long, g string").withColumn("h", keyed_hash("p", "id"))
    got = {r["id"]: r["_rank"] for r in hash_rank(df, "h", "id", partition_cols=["g"], bits=bits).collect()}
    want_df = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")) - 1)
    want = {r["id"]: r["w"] for r in want_df.collect()}
    assert got == want


@SETTINGS
@given(vals=st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=200))
def test_fixed_mean_is_exact(spark, vals):
    df = spark.createDataFrame([(v / 1e6,) for v in vals], "x double")
    got = df.agg(fixed_mean("x", 6).alias("m")).first()["m"]
    assert got == sum(vals) / len(vals) / 1e6
