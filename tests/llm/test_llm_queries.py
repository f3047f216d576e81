"""The registered queries against their SQL on the smallest tables."""

import os

import pytest
from compare import connect, difference, duck_result, spark_result

from jobweave.llm.queries import LLM_QUERIES, LLM_QUERY_SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_query(spark, name):
    got = spark_result(LLM_QUERIES[name](spark, SF))
    if name in LLM_QUERY_SQL:
        assert difference(got, duck_result(connect(SF), LLM_QUERY_SQL[name])) is None
    else:
        assert got[1]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
