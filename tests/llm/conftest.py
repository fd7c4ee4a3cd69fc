import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A DataFrame of rows under a schema."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build
