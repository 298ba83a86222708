import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from civicmart.session import build_session  # noqa: E402

TESTDATA = os.environ.get("CIVICMART_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", "civicmart-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
