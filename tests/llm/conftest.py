import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def bounded(spark):
    from eventmill.llm.common import bound_batches

    bound_batches(spark)
