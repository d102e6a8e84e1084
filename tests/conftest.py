import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from inkfall.session import local_session

    os.environ.setdefault("BENCH_CPUS", "4")
    s = local_session("tests", 4, "4g")
    yield s
    s.stop()
