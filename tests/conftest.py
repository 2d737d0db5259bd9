import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_spark

    s = get_spark(app="ledgerlens-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()
