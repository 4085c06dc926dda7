import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tallyforge.session import build_session
    s = build_session("local[*]", app="tallyforge-tests", shuffle_partitions=8, driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
