import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from evseq.session import local_session

    s = local_session(cpus="*", shuffle_partitions=8, app="evseq-tests")
    yield s
    s.stop()
