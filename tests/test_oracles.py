"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

from check_oracles import compare
from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    result = compare(spark, duck, sf_dir, name, queries()[name], SQL.get(name))
    if result == "EMPTY on both sides":
        pytest.skip("no rows at this scale")
    assert result == "" or result.startswith("rows only: ") and "EMPTY" not in result


def test_entry_has_rows(spark):
    assert entry(spark).count() == 10


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())
