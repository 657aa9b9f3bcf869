"""Every named query against its SQL on the smallest tables."""

import pytest

from foliospark.plans.registry import load_all
from tests.parity import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(load_all()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SMALL) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(load_all()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["stage", "count", "status"]
