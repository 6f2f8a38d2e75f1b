import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def spark():
    from ridepulse.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="ridepulse-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    yield con
    con.close()
