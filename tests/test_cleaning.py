"""The two property cleaning rounds on a frame in the reference's raw CSV schema."""

import random

from pyspark.sql import functions as F

from appraise.plans import cleaning as CL
from appraise.session import scratch_path
from appraise.sources import io
from appraise.sources.schema import PROPERTIES_RAW_SCHEMA, SENTINEL_DROP


def raw_properties(spark, n=300):
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        row = {}
        for f in PROPERTIES_RAW_SCHEMA.fields:
            name, t = f.name, f.dataType.simpleString()
            if name == "parcelid":
                row[name] = 10_000_000 + i
            elif rnd.random() < 0.3:
                row[name] = None
            elif t == "string":
                row[name] = rnd.choice(["true", "Y", "A1"])
            elif t == "double":
                row[name] = float(rnd.randint(1, 5000))
            elif name in ("latitude", "longitude"):
                row[name] = rnd.randint(33_000_000, 35_000_000)
            elif name == "buildingqualitytypeid":
                row[name] = rnd.choice([1, 4, 7, 10, 12])
            elif name == "unitcnt":
                row[name] = rnd.choice([1, 2, 3, 4, 9])
            elif name == "numberofstories":
                row[name] = rnd.choice([1, 2, 3, 4, 20])
            else:
                row[name] = rnd.randint(1, 300)
        rows.append(row)
    df = spark.createDataFrame(rows, PROPERTIES_RAW_SCHEMA)
    path = scratch_path(spark, "raw_props")
    df.write.mode("overwrite").option("header", True).csv(path)
    return CL.read_raw_properties(spark, path)


def test_read_raw_properties_renames_and_scales(spark):
    p = raw_properties(spark)
    assert "id_parcel" in p.columns and "parcelid" not in p.columns and len(p.columns) == 58
    lat = p.where(F.col("latitude").isNotNull()).select("latitude").first()[0]
    assert 33 <= lat <= 35


def test_round_one(spark):
    p = raw_properties(spark)
    out = CL.round_one(p).cache()
    assert out.count() == p.count()
    assert not set(CL.ROUND_ONE_DROP) & set(out.columns)
    for c in ["aircon", "heating", "area_total_calc", "tax_total", "area_garage", "build_year", "num_pool"]:
        assert out.where(F.col(c).isNull()).count() == 0, c
    assert {r[0] for r in out.select("aircon").distinct().collect()} >= {5}
    assert {r[0] for r in out.select("num_pool").distinct().collect()} <= {0, 1}
    filled_quality = out.join(p.where(F.col("quality").isNull()).select("id_parcel"), "id_parcel")
    assert {r[0] for r in filled_quality.select("quality").collect()} <= {1, 4, 7, 10}
    assert {r[0] for r in out.select("num_story").distinct().collect()} <= {"0", "1", "2", "3", "other"}
    assert {r[0] for r in out.select("flag_fireplace").distinct().collect()} <= {"0", "1", "2", "Y", "A1"}
    out.unpersist()


def test_sentinel_round(spark):
    p = raw_properties(spark)
    out = CL.sentinel_round(p)
    assert not set(SENTINEL_DROP) & set(out.columns)
    nulls = out.select([F.count_if(F.col(c).isNull()).alias(c) for c in out.columns]).first()
    assert sum(nulls) == 0
    assert out.where(F.col("aircon") == -1).count() == p.where(F.col("aircon").isNull()).count()
    assert out.where(F.col("tax_total") == -999).count() == p.where(F.col("tax_total").isNull()).count()
