import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from obsgrid.session import local_session, remove_scratch

    s = local_session("*", shuffle_partitions=8, app="obsgrid-tests")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="obsgrid-test-ckpt-"))
    yield s
    remove_scratch(s)
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="obsgrid-test-")
