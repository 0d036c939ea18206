import pytest

from farebox.llm.common import prepare


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)
