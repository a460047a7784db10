import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = os.environ.get("STRATAFLOW_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from strataflow.session import get_spark
    s = get_spark("strataflow-tests", master="local[8]", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf01():
    return SF01


@pytest.fixture(scope="session")
def sf001():
    return SF001
