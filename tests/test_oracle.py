"""Every registered query agrees with its independent DuckDB SQL on the driver's sf0.001 tables."""

import pytest

import __spark_entry__ as entry_mod
from compare import SF_SMALL
from compare import compare, register_views
from ridepulse.plans.catalog import QUERIES  # the text operators have their own tests

SQL = entry_mod.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "performance_id"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    register_views(duck, SF_SMALL)
    problems = compare(QUERIES[name](spark, SF_SMALL), duck, SQL[name])
    assert not problems, problems
