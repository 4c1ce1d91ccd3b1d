"""Types inferred from every cell; level dictionaries over range partitions."""

import datetime

import numpy as np
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from appraise.operators import dictionary as D
from appraise.operators import encode as E
from appraise.operators import inference as I


def test_the_lattice(spark):
    cols = {"i": ["1", " -2 ", "+3", ""], "b": ["1", "3000000000", None, "4"], "d": ["1", "2.5", "1e3", ".5"], "huge": ["99999999999999999999", "1", "2", "3"],
            "day": ["2016-01-31", "2016-02-29", None, ""], "bad_day": ["2016-02-30", "2016-01-01", None, ""], "mixed": ["2016-01-01", "7", None, ""],
            "late": ["1", "2", "3", "x"], "none": [None, "", "NA", "  "], "letters": ["1d", "2", "3", "4"], "na": ["NA", "1", "2", "NA"]}
    rows = list(zip(*cols.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).repartition(3)
    got = {r.column: r.type for r in I.infer(df, missing=["NA"]).collect()}
    assert got == {"i": "int", "b": "bigint", "d": "double", "huge": "double", "day": "date", "bad_day": "text", "mixed": "text", "late": "text",
                   "none": "missing", "letters": "text", "na": "int"}
    typed = I.retype(df, missing=["NA"])
    assert [t for _, t in typed.dtypes] == ["int", "bigint", "double", "double", "date", "string", "string", "string", "string", "string", "int"]
    assert sorted(r.i for r in typed.where("i is not null").collect()) == [-2, 1, 3]
    assert typed.where("day is not null").agg(F.max("day")).first()[0] == datetime.date(2016, 2, 29)
    assert {r.type for r in I.infer(df.where("false")).collect()} == {"missing"}


def test_one_late_bad_cell_in_many_rows(spark):
    df = spark.range(50_000).select(F.when(F.col("id") == 49_999, "oops").otherwise(F.col("id").cast("string")).alias("x"))
    r = I.infer(df).first()
    assert (r.type, r.n, r.n_int) == ("text", 50_000, 49_999)


def test_dictionary_equals_the_indexer_and_stays_distributed(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 17 == 0, None).otherwise(F.concat(F.lit("lé"), (F.col("id") * 7919 % 2500).cast("string"))).alias("x"))
    d = D.level_dictionary(df, "x")
    want = {r.x: r.c for r in E.level_codes(df, "x", "c").where("x is not null").select("x", "c").distinct().collect()}
    assert {r.level: r.code for r in d.collect()} == want
    for first, name in ((None, "c"), (-999, "c")):
        a = {r.id: r.c for r in D.with_codes(df, "x", "c", d, first).collect()}
        assert a == {r.id: r.c for r in E.level_codes(df, "x", name, first_code=first).collect()}
    assert D.level_dictionary(df.where("false"), "x").collect() == []


def test_sparse_design_matrix_for_mllib(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.normal()), f"g{i % 4}", None if i % 9 == 0 else f"h{i % 3}") for i in range(400)]
    rows = [(*r, 2 * r[1] + {"g0": 0, "g1": 1, "g2": -2, "g3": 4}[r[2]]) for r in rows]
    df = spark.createDataFrame(rows, "id long, a double, g string, h string, y double")
    made, blocks = D.design_matrix(df, ["a"], {c: D.level_dictionary(df, c) for c in ("g", "h")})
    assert blocks == [("numeric", 0, 1), ("g", 1, 3), ("h", 4, 2)] and made.count() == 400
    v = {r.id: r.features for r in made.collect()}
    assert v[6].toArray().tolist() == [rows[6][1], 0, 1, 0, 0, 0] and np.count_nonzero(v[0].toArray()) == 1
    fit = LinearRegression(labelCol="y").fit(made)
    assert np.allclose(fit.coefficients.toArray(), [2, 1, -2, 4, 0, 0], atol=1e-6)
