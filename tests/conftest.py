import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from segflow.session import drop_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "segflow-tests", "6g")
    yield session
    drop_scratch(session)
    session.stop()
