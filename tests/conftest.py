import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ordermart.session import build_session
    extra = {}
    s = build_session("local[4]", shuffle_partitions=8, extra=extra)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordermart-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    from ordermart.compare import duck_connection
    return duck_connection(SF_SMALL)
