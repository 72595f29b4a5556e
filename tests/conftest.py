import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session

    yield session(4)


@pytest.fixture(scope="session")
def inputs(spark):
    from checks.queries import Inputs

    return Inputs(spark, SF_DIR)
