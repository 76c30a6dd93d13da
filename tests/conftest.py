import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexmill import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", **{"spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def corpus(spark):
    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "row_ord bigint, text string")

    return make
