import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skylane.session import get_spark

    s = get_spark("skylane-tests", cpus="*", shuffle_partitions=8)
    yield s
    s.stop()
