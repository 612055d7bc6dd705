import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakelayers.plans.oracles import ORACLES
from lakelayers.plans.queries import QUERIES
from tests.oracle import assert_same, duckdb_on

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_on(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, connection, name):
    assert_same(QUERIES[name](spark, SF_DIR), connection, ORACLES[name])


def test_entry(spark, connection):
    assert_same(entry(spark), connection, ORACLES["full_chain"])
