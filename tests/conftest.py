import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from framecurate.session import get_spark
    s = get_spark("local[4]", 4, app_name="framecurate-tests")
    yield s
