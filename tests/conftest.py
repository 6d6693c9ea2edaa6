import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # tests only: a local checkpoint folder when the session names none
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quire-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="quire-test-")
