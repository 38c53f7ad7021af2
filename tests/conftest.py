import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakestrata.session import checkpoint_root, local_session
    s = local_session(4, shuffle_partitions=4, app="lakestrata-tests")
    checkpoint_root(s)  # tests: no shared folder configured -> a private one
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE_DIR
