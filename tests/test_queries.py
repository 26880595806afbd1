"""Every named query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from oracle import checker, difference
from tidemark.plans import ALL


@pytest.fixture(scope="module")
def con(sf):
    return checker(sf)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert {"pv_count", "uv_count", "ip_count"} <= set(df.columns)
    assert df.count() > 0
