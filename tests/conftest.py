import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spindle.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="spindle-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from spindle.plans.verify import duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_mid():
    from spindle.plans.verify import duck
    return duck(SF_MID)
