import pytest
from loanloom.llm.ship import prepare


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)
