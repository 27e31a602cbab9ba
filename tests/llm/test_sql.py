"""The queries that SQL can express, against DuckDB."""

import pytest
from check import connect, difference

from basketry.llm import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, name):
    assert difference(QUERIES[name](spark, data), connect(data), ORACLES[name]) == ""


def test_registered_once_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
