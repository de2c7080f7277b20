import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.plans.session import build_session

    s = build_session(master="local[4]", app_name="ledgerflow-tests", shuffle_partitions=8)
    yield s
    s.stop()
