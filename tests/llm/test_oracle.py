from __future__ import annotations

import pytest

from tests.compare import connect, differences
from tests.conftest import MEDIUM, SMALL
from tidemark.llm.oracle import SQL
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    only_spark, only_sql, ours, theirs = differences(QUERIES[name](spark, MEDIUM), connect(MEDIUM), SQL[name])
    assert ours == theirs
    assert not only_spark and not only_sql, (list(only_spark.items())[:3], list(only_sql.items())[:3])


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_the_smallest_tables(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
