import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dealcast.session import local_session, stop
    s = local_session(4, shuffle_partitions=4, app="dealcast-tests")
    yield s
    stop(s)


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
