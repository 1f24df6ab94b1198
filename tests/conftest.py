import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from biomesheaf.session import cohort_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = cohort_session("tests", "local[8]", shuffle_partitions=4, driver_memory="4g", scratch=tempfile.mkdtemp(prefix="scratch-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
