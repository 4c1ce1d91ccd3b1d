"""Every registered query with an oracle text equals its DuckDB result (rows, names, values)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import canon
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
                 "DATE": "date"}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    con = duck(SF_SMALL)
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[key])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert spark_types == {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(ocols, rel.types)}
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "n_sales", "mean_logerror", "mean_tax_total", "mean_price_per_unit"]
    assert df.count() > 0
