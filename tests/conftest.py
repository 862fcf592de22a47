import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orrery.session import local_session
    s = local_session(4, shuffle_partitions=4, driver_memory="4g",
                      checkpoint_dir=tempfile.mkdtemp(prefix="orrery-test-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="orrery-t-")
