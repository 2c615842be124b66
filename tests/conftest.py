import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudlake.session import checkpoint_root, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="fraudlake-tests")
    checkpoint_root(s)  # tests only: a private folder when the session names none
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fraudlake-test-")
