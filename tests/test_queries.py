"""Every registered query, against its SQL twin where there is one."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    if name in SQL:
        assert compare(spark, con, QUERIES[name], SQL[name], SF) is None
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
