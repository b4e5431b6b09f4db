import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from filmgraph import session

    s = session.build_session("local[4]", "filmgraph-tests",
                              {"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    session.checkpoint_root(s)   # sets a temporary checkpoint folder only if none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    """A fresh folder per test (never reused, never cleaned by the test)."""
    return tempfile.mkdtemp(prefix="filmgraph-test-")
