"""Every registered query against its SQL on the smallest data folder."""

import os

import oracle
import pytest

from daybook.suite import oracle_sql, queries

SF = os.environ.get("DAYBOOK_TEST_SF", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(oracle.spark_bag(QUERIES[name](spark, SF)), oracle.duck_bag(con, SQL[name])) == ""
