"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import pytest
from check_oracle import compare
from conftest import SMALL

from saleslens.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    text, _, ok = compare(spark, duck, name, QUERIES[name], ORACLES[name], SMALL)
    # An empty result is right where SQL is empty too (few rows at this size).
    assert ok or text.endswith("EMPTY"), text


def test_every_query_is_known_to_the_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 182 and set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
