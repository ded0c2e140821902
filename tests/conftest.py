import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tremor.session import build_session
    s = build_session("local[4]", app="tremor-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables not present")
    return SF_SMALL


@pytest.fixture(scope="session")
def sf_mid():
    if not os.path.isdir(SF_MID):
        pytest.skip("test tables not present")
    return SF_MID
