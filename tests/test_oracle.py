"""Every registered query against its DuckDB twin on the sf0.01 tables."""

import pytest

from oracle_compare import compare, duck_connection
from star_cases import SF_ORACLE
from vitrine.plans.catalog import queries
from vitrine.plans.oracle_sql import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_oracle(spark, con, name):
    assert name in ORACLE, "every registered query has a SQL twin"
    ok, msg = compare(spark, con, name, SF_ORACLE)
    assert ok, msg
