import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A DataFrame from rows and a schema, in a few partitions."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)

    return build


@pytest.fixture(scope="session")
def documents(spark, folder):
    """The documents as Python rows."""
    return {row.doc_id: row for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
