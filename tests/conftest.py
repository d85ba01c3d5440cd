import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, checkpoint_dir, release_tables

    s = build_session("local[*]", partitions=8, app="tidemark-tests")
    checkpoint_dir(s)
    yield s
    release_tables(s)
    s.stop()
