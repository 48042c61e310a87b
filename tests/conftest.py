import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tickwell.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tickwell-tests")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
