import os
import sys
import tempfile

import pytest

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(TESTS))
# Python workers import the test helpers too.
os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(TESTS), TESTS, os.environ.get("PYTHONPATH", "")])

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="tidemark-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
