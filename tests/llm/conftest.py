import pytest

from stationcast.llm.base import findable


@pytest.fixture(autouse=True)
def package(spark):
    findable(spark)
