import os

import pytest

from tallyforge.session import build_session

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def tables(spark, folder):
    from tallyforge.workload.standins import Tables

    return Tables(spark, folder)


@pytest.fixture
def rows():
    """Rows as sorted tuples, for comparing DataFrames whatever their order."""

    def collect(df):
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return collect
