"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

from feedledger.plans.registry import load_all
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    q = QUERIES[name]
    df = q.build(spark, SF)
    if q.oracle is None:
        assert df.count() >= 0
        return
    problems, _, _ = compare(df, con, q.oracle)
    assert not problems, problems


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
