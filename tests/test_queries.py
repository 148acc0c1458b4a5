"""Every registered query equals its SQL on the smallest tables."""

import pytest

from caseweave import registry
from tests.oracle import duck, rows_of_duck, rows_of_spark


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    columns, rows = rows_of_spark(registry.QUERIES[name](spark, sf_dir))
    assert name in registry.ORACLES
    expected_columns, expected = rows_of_duck(duck(sf_dir), registry.ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry_imports_without_training_data_operators():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_query(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 4
