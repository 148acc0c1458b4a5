"""Each query that SQL can state equals its SQL on the smallest tables."""

import pytest

from caseweave.llm import registry
from tests.oracle import duck, rows_of_duck, rows_of_spark


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    columns, rows = rows_of_spark(registry.QUERIES[name](spark, sf_dir))
    expected_columns, expected = rows_of_duck(duck(sf_dir), registry.ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
