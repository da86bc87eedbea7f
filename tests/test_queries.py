"""Every registered query against its SQL check on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_module
from catalog import CASES

CHECKED = {name: sql for name, sql in entry_module.oracle_sql().items() if name in CASES}
UNCHECKED = sorted(set(CASES) - set(CHECKED))


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(CHECKED))
def test_equals_sql(spark, small, con, name):
    frame = entry_module.queries()[name](spark, small)
    assert difference(frame, con, CHECKED[name]) is None


def test_every_query_has_a_check():
    assert UNCHECKED == []


def test_entry_has_rows(spark):
    frame = entry_module.entry(spark)
    assert frame.count() > 0
    assert "nearest_budget_grocery_store" in frame.columns
