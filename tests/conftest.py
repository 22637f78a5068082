import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from linemill.session import checkpoint_dir, local_session
    s = local_session("*", 8)
    checkpoint_dir(s)
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
