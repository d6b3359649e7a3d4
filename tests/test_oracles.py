"""Every registered query gives the rows its SQL gives."""

import os

import pytest

from tallyforge.workload import load_queries
from tallyforge.workload.verify import connect, differences

# Trained in full by the larger check, `python -m tallyforge.workload.verify`.
SLOW = {"ml02_fare_model", "ml04_ranked_models"}
QUERIES = load_queries()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, folder, name):
    if name in SLOW and not os.environ.get("TEST_SLOW"):
        pytest.skip("slow model")
    assert differences(spark, connection, folder, QUERIES[name]) == []


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 170
