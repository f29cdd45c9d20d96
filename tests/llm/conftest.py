import pytest
from samples import DOCUMENTS, HARD


@pytest.fixture
def hard(spark):
    return spark.createDataFrame(HARD, DOCUMENTS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
