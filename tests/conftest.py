import os
import sys
import tempfile

os.environ.setdefault("OMP_NUM_THREADS", "1")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest

from fileledger.session import local_session


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("FILELEDGER_SCRATCH", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    session = local_session(4, "tests", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
