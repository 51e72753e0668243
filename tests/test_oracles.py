"""Every registered query with an oracle equals DuckDB at sf0.01."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import compare, duck
from tests.conftest import SF_CHECK

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_CHECK)
    problem = compare(df, con, ORACLES[key])
    assert problem is None, f"{key}: {problem}"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())
