import pytest

from cataloom.llm import reachable


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    reachable(spark)
