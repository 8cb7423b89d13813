"""Every pixel query against its SQL twin at the smallest scale."""

import pytest

from pixelseries.plans import registry

from .conftest import SF

NAMES = sorted(registry.queries())


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, same, name):
    same(registry.queries()[name](spark, SF), registry.oracle_sql()[name])


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
