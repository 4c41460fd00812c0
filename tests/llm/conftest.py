import pytest

from helixframe.llm.common import drop_stored


@pytest.fixture(scope="session", autouse=True)
def stored_files_go(spark):
    yield
    drop_stored(spark)
