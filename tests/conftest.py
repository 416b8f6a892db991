import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillroll.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="tillroll-tests",
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
