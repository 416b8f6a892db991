import pytest


@pytest.fixture()
def rows(spark):
    """Frame of rows from tuples; keeps tests short."""
    def make(data, schema):
        return spark.createDataFrame(data, schema)
    return make
