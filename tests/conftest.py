import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillcast.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tillcast-tests-")
    s = build_session("local[4]", shuffle_partitions=8, app_name="tillcast-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tillcast-case-")
