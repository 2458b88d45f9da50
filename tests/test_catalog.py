"""Every catalogued query against its SQL on DuckDB."""

import os

import pytest

from compare import compare, connect
from parley.plans import catalog, catalog_bot

ROOT = "/root/testdata"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    cache = {}
    return lambda sf_dir: cache.setdefault(sf_dir, connect(sf_dir))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, duck, name):
    # Some utterance rules only occur from 0.01 on.
    sf_dir = f"{ROOT}/sf0.01" if name in catalog_bot.QUERIES else f"{ROOT}/sf0.001"
    assert compare(spark, duck(sf_dir), sf_dir, catalog.QUERIES[name], catalog.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, f"{ROOT}/sf0.001").count() > 0


def test_entry_file(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["date", "client_type", "user_base", "total_users", "percent_users"]
