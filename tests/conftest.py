import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from graustein.session import local_session
    ckpt = tempfile.mkdtemp(prefix="graustein-test-ckpt-")
    s = local_session(4, shuffle_partitions=4, app="graustein-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="graustein-test-")
