import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terralume.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, shuffle_partitions=4, memory="3g")
    yield session
    session.stop()
