"""Every registered query against its plain-SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from spanledger.registry import CASES
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_counterparts_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CASES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CASES))
def test_query(spark, con, name):
    result = compare(spark, con, SF, name)
    assert result.startswith(("ok", "rows-only")), result
