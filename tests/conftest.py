import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mercato.session import get_session
    s = get_session("local[4]", app_name="mercato-tests", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="mercato-test-", dir="/tmp")
