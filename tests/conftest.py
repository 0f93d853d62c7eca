import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martlake.session import get_session

    s = get_session("local[4]", app="martlake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # shared checkpoint folder: the cluster's setting wins; set one only if unset
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martlake-chk-"))
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
