"""Registered queries of the subpackage against their DuckDB texts."""

import pytest

from tests.compare import connect, differences
from tests.llm.conftest import SF
from tillroll.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(oracles.TEXTS))
def test_same_as_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), oracles.TEXTS[name]) == []
