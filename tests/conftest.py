import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabwise.session import get_session
    ckpt = tempfile.mkdtemp(prefix="tabwise-test-ckpt-")
    s = get_session("local[4]", app="tabwise-tests", shuffle_partitions=4,
                    extra_conf={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tabwise-test-")
