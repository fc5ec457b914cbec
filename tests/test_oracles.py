"""Every registered query against its check SQL on the smallest tables."""

import pytest

from stratloom.registry import all_oracles, all_queries
from tools.check import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("key", list(all_queries()))
def test_query(spark, con, key):
    df = all_queries()[key](spark, FOLDER)
    sql = all_oracles().get(key)
    if sql is None:
        assert df.count() > 0
    else:
        problems, _ = compare(df, con, sql)
        assert not problems, problems


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "thickness_studied" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())
