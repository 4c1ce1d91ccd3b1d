"""Sources and sinks: typed CSV scan, CSV sink, parquet checkpoint, model persistence."""

import os
import tempfile

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import types as T

from appraise.session import checkpoint_root, scratch_path
from appraise.sources import io
from appraise.sources.schema import PROPERTIES_RAW_SCHEMA, PROPERTY_KEPT, PROPERTY_RENAMES, RENAME_MAP


def test_schema_has_58_columns_and_50_renames():
    assert len(PROPERTY_RENAMES) == 50 and len(PROPERTY_KEPT) == 8
    assert len(PROPERTIES_RAW_SCHEMA.fields) == 58
    assert RENAME_MAP["parcelid"] == "id_parcel"


def test_csv_sink_then_typed_scan(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "id long, s string, x double")
    path = scratch_path(spark, "csv_test")
    io.write_csv(df, path)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    assert '"' not in text and text.startswith("id,s,x")
    back = io.read_csv(spark, path, T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()),
                                                   T.StructField("x", T.DoubleType())]))
    assert sorted(back.collect()) == sorted(df.collect())


def test_checkpoint_lives_under_the_configured_folder(spark):
    root = checkpoint_root(spark)
    df = spark.range(10)
    back = io.checkpoint_table(df, "ck")
    assert back.count() == 10
    assert scratch_path(spark, "x").startswith(root)


def test_model_persistence(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "a double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"), LinearRegression(labelCol="y")]).fit(df)
    path = os.path.join(tempfile.mkdtemp(prefix="appraise-model-"), "m")
    io.save_model(model, path)
    loaded = io.load_model(path)
    assert isinstance(loaded, PipelineModel)
    assert [r.prediction for r in loaded.transform(df).collect()] == [r.prediction for r in model.transform(df).collect()]


def test_lookup_csv_scan_then_fill(spark):
    from pyspark.sql import functions as F
    from appraise.operators.impute import fill_lookup
    from appraise.sources.schema import LOOKUP_ZIP_SCHEMA
    lk = spark.createDataFrame([(34100000, -118200000, 96001), (34200000, -118300000, 96002)], LOOKUP_ZIP_SCHEMA)
    path = scratch_path(spark, "zip_lookup")
    io.write_csv(lk, path)
    back = io.read_csv(spark, path, LOOKUP_ZIP_SCHEMA)
    props = spark.createDataFrame([(1, 34100000, -118200000, None), (2, 34200000, -118300000, 5),
                                   (3, 1, 2, None)], "id long, latitude long, longitude long, zip int")
    out = {r["id"]: r["zip"] for r in fill_lookup(props, back, ["latitude", "longitude"], "zip", "zip").collect()}
    assert out == {1: 96001, 2: 5, 3: None}


def test_rename_all_by_position(spark):
    from appraise.operators.columns import rename_all
    df = spark.createDataFrame([(1, 2.0)], "V1 long, V2 double")
    assert rename_all(df, ["parcelid", "pred"]).columns == ["parcelid", "pred"]
