"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect
from paths import FOLDER

from candor.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    message, _, _, rows = compare(spark, connection, name, QUERIES[name], FOLDER)
    assert message is None, message
    assert rows > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql())
    # Only queries of the pipeline operators may have no SQL.
    assert without.isdisjoint(QUERIES)
