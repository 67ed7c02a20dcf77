import pytest

from storelake.llm.common import prepared


@pytest.fixture(scope="session")
def llm(spark):
    return prepared(spark)
