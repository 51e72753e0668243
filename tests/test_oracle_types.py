"""Every oracle returns the same column names and types as its Spark query
(the driver compares schemas as well as values)."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import duck
from tests.conftest import SF_SMALL

DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_oracle_schema_matches(spark, con, key):
    spark_types = dict(queries()[key](spark, SF_SMALL).dtypes)
    rel = con.sql(oracle_sql()[key])
    duck_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
