import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripstar.session import build_session, work_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="tripstar-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    work_dir(session)  # sets a checkpoint folder only where none is configured
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test data not present")
    return SF_SMALL
