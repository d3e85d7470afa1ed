import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import local_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8)
    yield s


@pytest.fixture
def tmp_root(spark):
    """A fresh folder under the shared scratch root."""
    return scratch_dir(spark, "test")
