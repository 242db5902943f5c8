import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wardflow.session import checkpoint_dir, local_session
    s = local_session("4", 4, app="wardflow-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def ts(s: str):
    import datetime as dt
    return dt.datetime.fromisoformat(s)
