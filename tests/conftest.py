import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("8")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()
