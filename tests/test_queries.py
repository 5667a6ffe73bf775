"""Every registered query of the market library equals its SQL."""

from __future__ import annotations

import pytest

from tests.conftest import SMALL, rows_of, rows_of_sql
from tidalbook import queries as market


@pytest.mark.parametrize("name", sorted(market.queries()))
def test_query_equals_its_sql(spark, duck, name):
    sql = market.oracle_sql()[name]
    got = market.queries()[name](spark, SMALL)
    names, want = rows_of_sql(duck, sql)
    assert sorted(got.columns) == names
    assert rows_of(got) == want


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
