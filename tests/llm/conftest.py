import pytest


@pytest.fixture(scope="session")
def llm_spark(spark):
    from ledgerlens.llm.storage import importable

    importable(spark)
    return spark
