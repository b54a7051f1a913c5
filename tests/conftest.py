import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quotaloom.session import local_session
    s = local_session(8, "quotaloom-tests")
    yield s


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
