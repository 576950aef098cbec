from __future__ import annotations

import pytest

from __spark_entry__ import entry
from checks.oracle import all_sql
from checks.queries import all_queries
from tests.compare import connect, differences
from tests.conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def sql_tables():
    return connect(MEDIUM)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_sql(spark, sql_tables, name):
    only_spark, only_sql, ours, theirs = differences(
        all_queries()[name](spark, MEDIUM), sql_tables, all_sql()[name]
    )
    assert ours == theirs
    assert not only_spark and not only_sql, (
        list(only_spark.items())[:3],
        list(only_sql.items())[:3],
    )


def test_entry_has_rows(spark):
    assert entry(spark).count() == 946
    assert SMALL in "/root/testdata/sf0.001"
