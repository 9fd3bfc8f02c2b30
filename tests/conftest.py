import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("HIVEWIRE_SCRATCH", str(tmp_path_factory.mktemp("ckpt")))
    from hivewire.session import local_session
    s = local_session(4, shuffle_partitions=4, app="hivewire-tests")
    yield s
    s.stop()
