import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from playerledger.session import local_session
    ckpt = tempfile.mkdtemp(prefix="playerledger-test-ckpt-")
    s = local_session(4, shuffle_partitions=4, app="playerledger-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
