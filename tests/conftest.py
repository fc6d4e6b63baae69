import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from docket.session import build_session
    shared = tempfile.mkdtemp(prefix="docket-tests-")
    s = build_session(master="local[*]", shuffle_partitions=8, app="docket-tests",
                      extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def scratch(spark, tmp_path):
    # tests run locally: a per-test folder under the session's checkpoint dir
    from docket.session import scratch_path
    import uuid
    return scratch_path(spark, "tests", uuid.uuid4().hex)
