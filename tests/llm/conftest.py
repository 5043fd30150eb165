import pytest

from ebbtide.llm.shipping import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)
