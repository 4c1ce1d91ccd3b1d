"""One tiny frame per R-vs-SQL rule and the edge cases of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from appraise.functions import rsem
from appraise.operators import columns as C
from appraise.operators import encode as E
from appraise.operators import impute as I
from appraise.operators import joins as J


def test_flag_with_missing_stays_missing(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,)], "f string")
    got = [r[0] for r in df.select(rsem.flag_to_number("f", "true", 1, -1)).collect()]
    assert got == [1, -1, None]


def test_missing_is_not_a_member(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert [r[0] for r in df.select(rsem.isin_or_false("x", [1, 4])).collect()] == [True, False, False]


def test_bad_numeric_text_becomes_null(spark):
    df = spark.createDataFrame([("3",), ("other",), (None,), ("2.5",)], "t string")
    assert [r[0] for r in df.select(rsem.tolerant_number("t")).collect()] == [3.0, None, None, 2.5]


def test_zero_divisor_gives_null_not_error(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(rsem.safe_ratio("a", "b")).collect()] == [None, 2.5]


def test_fill_all_covers_text_and_numbers(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3.0, "a")], "id long, x double, s string")
    out = I.fill_all(df, -999, skip=["id"]).orderBy("id").collect()
    assert (out[0]["x"], out[0]["s"]) == (-999.0, "-999")
    assert (out[1]["x"], out[1]["s"]) == (3.0, "a")


def test_level_order_is_byte_order(spark):
    df = spark.createDataFrame([("10",), ("2",), ("-1",), ("2",)], "z string")
    out = E.level_codes(df, "z", "code").collect()
    codes = {r["z"]: r["code"] for r in out}
    assert codes == {"-1": 1, "10": 2, "2": 3}
    renamed = {r["z"]: r["code"] for r in E.level_codes(df, "z", "code", first_code=-999).collect()}
    assert renamed == {"-1": -999, "10": 1, "2": 2}


def test_duplicate_names_get_prefix(spark):
    left = spark.createDataFrame([(1, "a", 5.0)], "k long, status string, v double")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k long, status string")
    out = J.right_join_prefixed(left, right, "k")
    assert out.columns == ["k", "status", "v", "i_status"]
    assert out.count() == 2


def test_merged_flag_rules(spark):
    df = spark.createDataFrame([(1, "true"), (None, "true"), (None, None), (2, None)], "n int, f string")
    assert [r[0] for r in df.select(rsem.merged_flag("n", "f")).collect()] == ["1", "2", "0", "1"]


def test_collapse_levels_only_whole_numbers(spark):
    df = spark.createDataFrame([(3.0,), (4.0,), (4.5,), (41.0,), (42.0,), (None,)], "x double")
    got = [r[0] for r in df.select(rsem.collapse_levels("x", 4, 41)).collect()]
    assert got == ["3.0", "other", "4.5", "other", "42.0", None]


def test_empty_table_and_all_missing_column(spark):
    empty = spark.createDataFrame([], "id long, x double")
    assert I.impute_mean(empty, ["x"]).count() == 0
    allnull = spark.createDataFrame([(1, None), (2, None)], "id long, x double")
    assert [r["x"] for r in I.impute_mean(allnull, ["x"]).collect()] == [None, None]
    out = I.hot_deck(allnull, "x", "id", report=(rep := {}))
    assert out.count() == 2 and rep["unfilled"] == 2 and rep["donors"] == 0


def test_drop_and_positional_ignore_absent(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert C.drop_columns(df, ["b", "zz"]).columns == ["a", "c"]
    assert C.drop_positional(df, [0]).columns == ["b", "c"]
    assert C.numeric_columns(df).columns == ["a", "b", "c"]


def test_ids_print_as_digits(spark):
    df = spark.createDataFrame([(12000000.0,)], "id double")
    assert df.select(C.id_text("id")).first()[0] == "12000000"
    assert df.select(F.col("id").cast("string")).first()[0] != "12000000"


def test_level_codes_many_equals_single(spark):
    df = spark.createDataFrame([("10", "b"), ("2", None), ("-1", "a"), (None, "b")], "z string, s string")
    many = E.level_codes_many(df, {"z": ("zc", -999), "s": ("sc", None)}).collect()
    one = E.level_codes(E.level_codes(df, "z", "zc", first_code=-999), "s", "sc").collect()
    assert sorted(map(tuple, many), key=str) == sorted(map(tuple, one), key=str)
