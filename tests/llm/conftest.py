import pytest
from edge_data import EXTRA, documents


@pytest.fixture(scope="session")
def edges(spark):
    return documents(spark, schema=EXTRA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
