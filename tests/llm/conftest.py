import pytest

from jobweave.llm.common import prepare


@pytest.fixture()
def llm(spark):
    return prepare(spark)


@pytest.fixture()
def small_splits(llm):
    """Many small file splits, so that records and documents lie across their edges."""
    keys = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "1"}
    old = {k: llm.conf.get(k) for k in keys}
    for k, v in keys.items():
        llm.conf.set(k, v)
    yield llm
    for k, v in old.items():
        llm.conf.set(k, v)
