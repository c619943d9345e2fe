"""Every registered query equals its DuckDB oracle on the whole sf0.01 tables."""

import pytest

from conftest import SF001
from oracle_compare import duck, digest

from __spark_entry__ import entry, oracle_sql, queries
from mqtable.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = digest(queries()[name](spark, SF001).toPandas())
    want = digest(con.execute(oracle_sql()[name]).df())
    assert got == want


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["bound_queue", "batch_id", "n"]
    assert df.count() > 0
