"""Queries that SQL can express equal it on the whole sf0.01 tables."""

import pytest
from conftest import SF001
from oracle_compare import digest, duck

from mqtable.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert digest(QUERIES[name](spark, SF001).toPandas()) == digest(duck(SF001).execute(ORACLE[name]).df())


def test_one_query_per_operator():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
