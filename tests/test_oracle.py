"""Every registered query of the library proper against its SQL twin, on the smallest tables."""

import pytest

from fieldloom.plans import registry

from oracle import compare

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    assert compare(registry.queries()[name](spark, SF), SQL[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() >= 0
