"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import pytest

from oracle_check import compare, connect
from sceneloom.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [r.asDict(recursive=True) for r in df.collect()]
    assert rows
    if name in ORACLE_SQL:
        assert compare(rows, df.columns, con, ORACLE_SQL[name]) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
