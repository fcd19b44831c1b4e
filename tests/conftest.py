import os
import sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from harvest.session import get_spark
    s = get_spark("local[*]", app="harvest-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
