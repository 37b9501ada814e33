import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Builds a DataFrame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
