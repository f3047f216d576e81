"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from compare import connect, difference, duck_result, spark_result

from jobweave.queries import REGISTRY, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables not present")
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    got = spark_result(REGISTRY[name](spark, SF_DIR))
    if name in SQL:
        assert difference(got, duck_result(duck, SQL[name])) is None
    else:
        assert got[1]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(REGISTRY)
