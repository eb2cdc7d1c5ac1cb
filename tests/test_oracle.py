"""Every registered query with a DuckDB text gives the same rows on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.conftest import SMALL

TEXTS = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_text_belongs_to_a_query():
    assert set(TEXTS) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_same_as_duckdb(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, TEXTS[name]) == []


EXPECTED = {"order_items": 6000, "orders": 1500}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_documented_row_counts(star, name):
    assert star[name].count() == EXPECTED[name]
