import tempfile

import pytest

from segqa.session import local_session
from segqa.streaming import STATE_STORE


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session(4, "tests", **STATE_STORE, **{"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
