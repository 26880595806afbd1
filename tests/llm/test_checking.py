"""Corpus queries against the SQL that works them out the plain way."""

import pytest

from oracle import checker, difference
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), checker(sf), ORACLES[name]) is None
