import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from cytospark.session import get_spark
    s = get_spark(master="local[8]", shuffle_partitions=8)
    yield s
