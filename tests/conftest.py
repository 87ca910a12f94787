import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from visitflow.session import build_session, checkpoint_dir
    s = build_session("local[4]", app_name="visitflow-tests", shuffle_partitions=8)
    checkpoint_dir(s)          # only sets a scratch folder when the session has none
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="visitflow-test-")
