import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from linecast.session import build_session, ensure_checkpoint_dir

    s = build_session("local[*]", app_name="linecast-tests", shuffle_partitions=8,
                      extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="linecast-test-ckpt-")})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="linecast-test-")
