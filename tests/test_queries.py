"""Every registered query equals its SQL counterpart."""

import re

import pytest
from compare import database, differences

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


def test_every_query_has_sql():
    """Those of the language-model part, if present, have tests of their own instead."""
    assert {n for n in QUERIES if not re.match(r"op\d+_|pipeline$", n)} <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, sf_dir, name):
    found, problems = differences(spark, db, sf_dir, name, QUERIES[name], ORACLE[name])
    assert not problems
    assert found > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["plan_tier", "total_orders", "net_revenue"]
