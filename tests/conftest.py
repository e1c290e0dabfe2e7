import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("FOOTFALL_MASTER", "local[4]")
    os.environ.setdefault("FOOTFALL_SHUFFLE_PARTITIONS", "4")
    os.environ.setdefault("FOOTFALL_DRIVER_MEMORY", "8g")
    from footfall.session import get_session
    s = get_session()
    yield s
