import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A frame from rows and a schema text, over several partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
